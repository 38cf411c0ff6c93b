"""Quality rules as a short-circuit cascade.

Each rule is a test on one text. On a sample, every rule's time and share of rejects is measured; the rules then run
in the order of rejects per second, and a text that one rule rejects is not shown to the rest. The order changes the
work only: a text is kept if and only if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmart.llm.texts import doc_texts, map_arrow, texts_of
from retailmart.llm.textstats import TextStats

#: Rows in the sample that rule costs are measured on; the verdicts do not depend on it.
SAMPLE_ROWS = 2000
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Rule(NamedTuple):
    name: str
    rejects: Callable[[TextStats], bool]


def few_words(s: TextStats) -> bool:
    return s.n_words < 50


def repeats(s: TextStats) -> bool:
    return 100 * s.n_repeat_words > 50 * s.n_words


def symbols(s: TextStats) -> bool:
    return 100 * s.n_symbols > 40 * s.n_words


def shouting(s: TextStats) -> bool:
    return 100 * s.n_upper > 40 * s.n_letters


def repeated_lines(s: TextStats) -> bool:
    return 100 * s.n_dup_lines > 50 * s.n_lines


def digits(s: TextStats) -> bool:
    return 100 * s.n_digits > 40 * s.word_chars


def long_words(s: TextStats) -> bool:
    return s.word_chars > 25 * s.n_words


BASE_RULES = (Rule("few_words", few_words), Rule("repeats", repeats))
RULES = (
    *BASE_RULES,
    Rule("symbols", symbols),
    Rule("shouting", shouting),
    Rule("repeated_lines", repeated_lines),
    Rule("digits", digits),
    Rule("long_words", long_words),
)


def rule_costs(
    docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """(rule, seconds, rejected, tested) on a sample of about ``sample_rows`` rows; one row per rule and task."""
    total = docs.count()
    sample = docs.sample(min(1.0, sample_rows / max(total, 1)), seed=7) if total > sample_rows else docs
    texts = sample.select(F.col(text_col).cast("string").alias("text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        seconds, rejected = [0.0] * len(rules), [0] * len(rules)
        for text in texts_of(batch.column("text")):
            for k, rule in enumerate(rules):
                stats = TextStats(text)  # afresh: a rule pays for all that it needs
                began = time.perf_counter()
                rejected[k] += rule.rejects(stats)
                seconds[k] += time.perf_counter() - began
        rows = [[r.name for r in rules], seconds, rejected, [batch.num_rows] * len(rules)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["rule", "seconds", "rejected", "tested"])

    found = map_arrow(texts, work, "rule string, seconds double, rejected long, tested long")
    return found.groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("seconds", "rejected", "tested")])


def cascade_order(
    docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS
) -> list[Rule]:
    """The rules by rejects per second, the best first; one row per rule comes to the driver. Ties keep their order."""
    measured = {r["rule"]: r["rejected"] / max(r["seconds"], 1e-9) for r in rule_costs(docs, text_col, rules, sample_rows).collect()}
    return sorted(rules, key=lambda r: -measured.get(r.name, 0.0))


def quality_verdicts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: Sequence[Rule] = RULES,
    counts: Sequence[str] = (),
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(doc_id, kept, rejected_by, base_failed, *counts), one row per input row.

    ``counts`` names counts of ``TextStats`` to return for every row, rejected or not. ``rejected_by`` is the first
    rule of the cascade that rejects, so it depends on the order measured; ``kept`` does not. ``base_failed`` says
    whether one of the base rules rejects. A null text counts as empty and is rejected for want of words. An empty
    table gives no rows. Other columns are not read.
    """
    order = cascade_order(docs, text_col, rules, sample_rows)
    base = {r.name for r in BASE_RULES}
    names = ["doc_id", "kept", "rejected_by", "base_failed", *counts]

    def judged(text: bytes) -> tuple:
        stats = TextStats(text)
        by = next((r.name for r in order if r.rejects(stats)), None)
        failed = by in base or by is not None and any(r.rejects(stats) for r in BASE_RULES)
        return (by is None, by, failed, *[getattr(stats, c) for c in counts])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(zip(*[judged(t) for t in texts_of(batch.column("text"))]))
        kinds = [pa.bool_(), pa.string(), pa.bool_(), *[pa.int64()] * len(counts)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(x, k) for x, k in zip(columns, kinds)]], names)

    schema = "doc_id long, kept boolean, rejected_by string, base_failed boolean" + "".join(f", {c} long" for c in counts)
    return map_arrow(doc_texts(docs, id_col, text_col), work, schema)


def quality_filter(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, whose text no rule rejects: one pass, no shuffle."""
    order = cascade_order(docs, text_col, rules, sample_rows)

    def run(batches):
        for batch in batches:
            keep = []
            for text in texts_of(batch.column(batch.schema.get_field_index(text_col))):
                stats = TextStats(text)
                keep.append(not any(r.rejects(stats) for r in order))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
