"""Seed tables (FIXED VALUES): country reference, group membership, ISO2->ISO3 crosswalk."""

import os

from pyspark.sql import DataFrame, SparkSession

from gridmix import schemas
from gridmix.sources.readers import read_seed

SEED_DIR = os.path.dirname(os.path.abspath(__file__))


def seed_path(name: str) -> str:
    return os.path.join(SEED_DIR, f"{name}.csv")


def country_reference(spark: SparkSession) -> DataFrame:
    return read_seed(spark, seed_path("country_reference"), schemas.COUNTRY_REFERENCE)


def country_group_membership(spark: SparkSession) -> DataFrame:
    return read_seed(spark, seed_path("country_group_membership"), schemas.GROUP_MEMBERSHIP)


def country_crosswalk(spark: SparkSession) -> DataFrame:
    return read_seed(spark, seed_path("country_crosswalk"), schemas.CROSSWALK)
