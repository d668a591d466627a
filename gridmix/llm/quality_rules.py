"""Quality rules: a threshold table compiled into one projection.

Counts (words, symbols, lines, repeats) are built-in column expressions, a rule
is a ratio of two counts with bounds, and the table of rules becomes one
``select``. No user function runs, and no row moves: the plan is a scan and a
projection.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmix.llm.common import numbered, place_of

GAP = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
REPEAT_WINDOW = 5

#: FIXED VALUES: frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "was", "with", "are", "this", "from", "have", "not",
    "der", "die", "das", "und", "den", "von", "mit", "ist", "nicht", "ein", "eine", "auf", "für", "als", "auch",
    "le", "la", "les", "de", "des", "et", "est", "une", "dans", "que", "qui", "pour", "sur", "avec", "par",
    "el", "los", "las", "del", "y", "que", "por", "con", "para", "una", "no", "su", "como", "más", "en",
)


#: FIXED VALUES: the languages that these words are of.
LISTED = ("en", "de", "fr", "es")


@dataclass(frozen=True)
class Rule:
    """``low <= count / base <= high``; a rule with no base (0), or one under ``least``, holds."""

    name: str
    count: str
    base: str
    low: float = 0.0
    high: float = float("inf")
    least: int = 0


#: The threshold table. The stop-word rule is for texts whose language has a list, and so long that its
#: share means several words.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols_per_word", "n_symbols", "n_words", high=0.3),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.4),
    Rule("stop_words", "n_stop_words", "listed_words", low=0.03, least=100),
    Rule("words_per_line", "n_words", "n_lines", low=3.0),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once however often it is used."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column, window: int = REPEAT_WINDOW) -> Column:
    """Words inside a window of ``window`` words that the text has at least twice.

    Windows are compared by 64-bit hash (of n windows, two different ones agree
    with a chance of n**2 / 2**65). A text without any repeat, the usual case,
    ends at the first test.
    """
    def covered(at: Column) -> Column:
        gaps = F.zip_with(F.slice(at, 1, F.size(at) - 1), F.slice(at, 2, F.size(at) - 1),
                          lambda a, b: F.least(b - a, F.lit(window)))
        return F.aggregate(gaps, F.lit(window).cast("long"), lambda n, g: n + g)

    def repeated(hashes: Column) -> Column:
        keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(keyed, lambda k: F.sort_array(F.transform(F.filter(k, lambda e, n: (
            F.coalesce(F.get(k, n - 1)["h"] == e["h"], F.lit(False))
            | F.coalesce(F.get(k, n + 1)["h"] == e["h"], F.lit(False)))), lambda e: e["i"])))

    def hashes(own: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(own) - window),
                           lambda i: F.xxhash64(*[F.get(own, i + k) for k in range(window)]))

    return F.when(F.size(words) <= window, F.lit(0).cast("long")).otherwise(
        let(let(F.transform(words, lambda x: F.xxhash64(x)), hashes), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
            .otherwise(let(repeated(h), covered))))


def any_of(words: Sequence[str]) -> str:
    """A pattern for any of the words in any case, with common beginnings written once."""
    def either(c: str) -> str:
        return f"[{c}{c.upper()}]" if c.upper() != c and len(c.upper()) == 1 else re.escape(c)

    def branch(rest: list[str]) -> str:
        heads = sorted({w[0] for w in rest if w})
        tails = [either(h) + branch([w[1:] for w in rest if w[:1] == h]) for h in heads]
        if not tails:
            return ""
        return f"(?:{'|'.join(tails)})" + ("?+" if "" in rest else "")

    return branch(sorted({w.lower() for w in words}))


def listed(lang: Column, languages: Sequence[str] = LISTED) -> Column:
    """Whether stop words of a language are known; ``en-GB`` is ``en``, and null is no language."""
    return F.coalesce(F.substring_index(F.lower(lang), "-", 1).isin(list(languages)), F.lit(False))


def counts(text: Column, known: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """All counts of a text as one struct, the words split once. ``listed_words`` are its words if its
    stop words are ``known``, else 0."""
    stops = rf"(?<![^\x20\x09-\x0D]){any_of(stop_words)}(?![^.,;:?\x20\x09-\x0D])"
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(F.array_remove(F.split(text, GAP), ""), lambda w: let(lines, lambda k: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size(k) - F.size(F.array_distinct(k))).cast("long").alias("n_dup_lines"),
        repeat_words(w).alias("n_repeat_words"),
        F.size(k).cast("long").alias("n_lines"),
        F.regexp_count(text, F.lit(stops)).cast("long").alias("n_stop_words"),
        F.when(known, F.size(w)).otherwise(0).cast("long").alias("listed_words"))))


def holds(rule: Rule, values: Column) -> Column:
    count, base = values[rule.count].cast("double"), values[rule.base]
    test = F.lit(True)
    if rule.low > 0:
        test = test & (count >= rule.low * base)
    if rule.high < float("inf"):
        test = test & (count <= rule.high * base)
    return (base < max(rule.least, 1)) | test


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, min_words: int = 10, max_repeat_percent: int = 20,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: its counts, ``base_failed``, ``kept`` and the names of failed rules.

    A null or empty text has no words and fails the base rule. Equal rows give
    equal rows; extra columns are left out, and an empty table gives no rows. The
    stop-word rule holds for every text of a language without a list (LISTED),
    of a null language, and of a table without a column ``lang_col``.
    """
    source = numbered(docs).select(
        F.col(f"c{place_of(docs, id_col)}").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"c{place_of(docs, text_col)}").cast("string"), F.lit("")).alias("text"),
        language(docs, lang_col).alias("lang"))
    measured = source.select("doc_id", counts(F.col("text"), listed(F.col("lang"))).alias("c"))
    c = F.col("c")
    failed, base_failed = compiled(rules, c), base(c, min_words, max_repeat_percent)
    return measured.select(
        "doc_id", c["n_words"].alias("n_words"), c["word_chars"].alias("word_chars"),
        c["n_symbols"].alias("n_symbols"), c["n_dup_lines"].alias("n_dup_lines"),
        c["n_repeat_words"].alias("n_repeat_words"), base_failed.alias("base_failed"),
        (~base_failed & (F.size(failed) == 0)).alias("kept"),
        c["n_lines"].alias("n_lines"), c["n_stop_words"].alias("n_stop_words"), c["listed_words"].alias("listed_words"),
        failed.alias("failed_rules"))


def language(docs: DataFrame, lang_col: str) -> Column:
    """The language column of ``numbered`` docs, null where the table has none."""
    there = any(c.lower() == lang_col.lower() for c in docs.columns)
    return (F.col(f"c{place_of(docs, lang_col)}") if there else F.lit(None)).cast("string")


def compiled(rules: Sequence[Rule], values: Column) -> Column:
    """The names of the rules that fail, in the table's order."""
    names = [F.when(~holds(r, values), F.lit(r.name)) for r in rules]
    return F.filter(F.array(*names), lambda x: x.isNotNull()) if names else F.array().cast("array<string>")


def base(values: Column, min_words: int, max_repeat_percent: int) -> Column:
    return (values["n_words"] < min_words) | (100 * values["n_repeat_words"] > max_repeat_percent * values["n_words"])


def without_poor(docs: DataFrame, rules: Sequence[Rule] = RULES, min_words: int = 10, max_repeat_percent: int = 20,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` as it is, all its columns whatever they are called, without the rows that fail the
    base rule or a rule. A null or empty text fails, repeated rows stay or go together, and an empty
    table stays empty.

    The verdict is one expression over counts bound once: a filter on counted
    columns would be pushed below them, and each use would count anew.
    """
    text = F.coalesce(F.col(f"c{place_of(docs, text_col)}").cast("string"), F.lit(""))
    return numbered(docs).where(let(counts(text, listed(language(docs, lang_col))), lambda c: reduce(
        lambda x, y: x & y, [holds(r, c) for r in rules], ~base(c, min_words, max_repeat_percent)))).toDF(*docs.columns)
