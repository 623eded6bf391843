"""Host-level quality rules: rule failures summed by host, shrunk, and joined back."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.llm.common import map_texts, written

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, first occurrence included."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
    size = len(seen)
    pairs = ids[:-1] * size + ids[1:]
    if size > 2_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(codes := pairs[:-1] * size + ids[2:], kind="stable")
    ranked = codes[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(codes) + 2, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = twice.copy()
    covered[1:] |= twice[:-1]
    covered[2:] |= twice[:-2]
    return int(covered.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def _counter():
    return lambda texts: list(zip(*map(text_counts, texts), strict=True)) or [[]] * len(COUNTS)


@dataclass(frozen=True)
class HostRules:
    """Limits of the rules of one document, and of a host's shrunk failure rate."""

    least_words: int = 50
    repeat_percent: int = 50
    symbols_percent: int = 10
    dup_lines_percent: int = 30
    least_word_chars: int = 3
    most_word_chars: int = 12
    most_rate: float = 0.5


def count_rules(docs: DataFrame, rules: HostRules, id_col: str, text_col: str, host_col: str) -> DataFrame:
    n = F.col("n_words")
    counted = map_texts(
        docs.select(F.col(id_col), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), text_col),
        text_col, [id_col, "host"], _counter, [(c, "bigint") for c in COUNTS],
    )
    return counted.select(
        "*",
        ((n < rules.least_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * n)).alias("base_failed"),
        (n < rules.least_words).alias("fail_short"),
        (100 * F.col("n_repeat_words") > rules.repeat_percent * n).alias("fail_repeat"),
        (100 * F.col("n_symbols") > rules.symbols_percent * n).alias("fail_symbols"),
        (100 * F.col("n_dup_lines") > rules.dup_lines_percent * F.col("n_lines")).alias("fail_lines"),
        ((F.col("word_chars") < rules.least_word_chars * n) | (F.col("word_chars") > rules.most_word_chars * n)).alias("fail_length"),
    )


FAILURES = ("fail_short", "fail_repeat", "fail_symbols", "fail_lines", "fail_length")


def host_verdicts(counted: DataFrame, rules: HostRules) -> DataFrame:
    """One row for each host: documents, shrunk failure rate of each rule, verdict.

    For each rule the hosts' rates give a beta prior by the method of moments (its strength
    held within 1 to 1000 documents); a host's rate is the posterior mean.
    """
    hosts = counted.groupBy("host").agg(
        F.count("*").alias("n_docs"), *[F.sum(F.col(f).cast("bigint")).alias(f) for f in FAILURES]
    )
    rate = {f: F.col(f) / F.col("n_docs") for f in FAILURES}
    prior = hosts.agg(
        *[F.avg(rate[f]).alias(f"m_{f}") for f in FAILURES], *[F.var_pop(rate[f]).alias(f"v_{f}") for f in FAILURES]
    )
    both = hosts.crossJoin(F.broadcast(prior))  # the prior is one row
    shrunk = {}
    for f in FAILURES:
        m, v = F.col(f"m_{f}"), F.col(f"v_{f}")
        strength = F.when(v > 0, F.least(F.greatest(m * (1 - m) / v - 1, F.lit(1.0)), F.lit(1000.0))).otherwise(1000.0)
        shrunk[f] = (F.col(f) + m * strength) / (F.col("n_docs") + strength)
    bad = [shrunk[f] > rules.most_rate for f in FAILURES]
    verdict = ~(bad[0] | bad[1] | bad[2] | bad[3] | bad[4])
    return both.select("host", "n_docs", *[shrunk[f].alias(f"rate_{f[5:]}") for f in FAILURES], verdict.alias("host_kept"))


def apply_host_rules(
    docs: DataFrame, rules: HostRules | None = None, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """Counts and verdicts of every document; ``kept`` needs its own base rules and its host's.

    Null or empty text: no words, so ``base_failed``.  Whole texts are counted, however long; an id
    may be null.  A null host is the host ``''``.  Repeated
    rows are judged one by one; an empty table gives an empty result; other columns are not read.
    The documents are read once: counts go to the shared folder, then host sums (partial before
    the shuffle, so a hot host is one row a task) and the verdicts are joined back.
    """
    rules = rules or HostRules()
    counted = written(count_rules(docs, rules, id_col, text_col, host_col), "rules")
    verdicts = written(host_verdicts(counted, rules).select("host", "host_kept"), "hosts")
    if verdicts.count() <= 100_000:
        verdicts = F.broadcast(verdicts)  # few enough to send; a hot host then needs no exchange
    return counted.join(verdicts, "host", "left").withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))
