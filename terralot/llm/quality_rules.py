"""Quality rules by document and by host.

Method: rule failures are counted by host; each host's failure rate is shrunk by an empirical beta
prior (fitted to the hosts' rates by moments), and the host's verdict is joined back to its
documents. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
BREAKS, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED, HOST_LIMIT = 50, 50, 0.5


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more. Windows are compared by 64-bit hashes:
    sorted with their places, equal ones are neighbours; each then covers the words up to the next."""
    n = F.size(words)

    def covered(pairs: Column) -> Column:
        same = lambda x, i, step: F.coalesce(x["h"] == F.get(pairs, i + step)["h"], F.lit(False))
        places = F.transform(pairs, lambda x, i: F.when(same(x, i, -1) | same(x, i, 1), x["i"]))
        return let(
            F.sort_array(F.filter(places, lambda p: p.isNotNull())),
            lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x
            ),
        )

    def by_hash(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(pairs, covered)).otherwise(F.lit(0).cast("long"))

    windows = F.slice(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))), F.lit(1), F.greatest(n - 2, F.lit(0)))
    return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(windows, by_hash))


def measured(docs: DataFrame, doc_id: str, text: str, source: str, carry: list[str]) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), t.alias("t"), *[F.col(c).alias("_" + c) for c in carry])
    kept = ["_" + c for c in carry]
    without = lambda s: F.length(F.translate("t", s, "")).cast("long")
    words = F.array_remove(F.split("t", BREAKS, -1), "")
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(WORD))
    counts = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    rows = rows.select("doc_id", "source", counts.alias("c"), without(SPACE).alias("word_chars"), (F.length("t") - without(SYMBOLS)).cast("long").alias("n_symbols"), let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"), *kept)
    return rows.select("doc_id", "source", "c.n_words", "word_chars", "n_symbols", "n_dup_lines", "c.n_repeat_words", *kept)


def host_verdicts(rows: DataFrame, limit: float) -> DataFrame:
    """(source, host_docs, host_rate, host_failed) of every source but null. With no variance
    between hosts, every host has the mean rate."""
    hosts = rows.filter("source IS NOT NULL").groupBy("source").agg(F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("fails"))
    hosts = staged(hosts, "hosts")
    rate = F.col("fails") / F.col("host_docs")
    prior = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"))
    weight = F.when(F.col("v") > 0, F.greatest(F.col("m") * (1 - F.col("m")) / F.col("v") - 1, F.lit(0.0)))
    prior = prior.select("m", weight.alias("k")).first()
    m, k = (prior["m"] or 0.0), prior["k"]
    shrunk = F.lit(m) if k is None else (F.col("fails") + F.lit(m * k)) / (F.col("host_docs") + F.lit(k))
    return hosts.select("source", "host_docs", shrunk.cast("double").alias("host_rate"), (shrunk >= limit).alias("host_failed"))


def quality_rules(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED, host_limit: float = HOST_LIMIT,
    carry: list[str] | None = None,
) -> DataFrame:
    """Counts, base_failed and kept of every row, with its host's shrunk failure rate.

    A document is kept if its own rules pass and its host's shrunk rate is below `host_limit`.
    Null text: no words, so it fails. Null source: no host, judged alone. Null and repeated ids
    and repeated rows are judged row by row. Texts of any length are counted whole. A host whose rate
    equals `host_limit` fails. No rows give none. Columns named in `carry` are passed on
    with `_` before their names; others are ignored.
    """
    rows = measured(docs, doc_id, text, source, carry or [])
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    rows = staged(rows.withColumn("base_failed", failed), "rules")
    hosts = staged(host_verdicts(rows, host_limit), "host-verdicts")  # of known size: broadcast only if small, else joined with skewed hosts split
    joined = rows.join(hosts, "source", "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False))).alias("kept"), "source", "host_rate", *["_" + c for c in carry or []],
    )
