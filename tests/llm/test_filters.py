"""Quality rules, decontamination, the models and the pipeline."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from retailmart.llm import queries
from retailmart.llm.decontaminate import ItemIndex, contained_items, decontaminate
from retailmart.llm.quality_gam import fit_quality, score_quality
from retailmart.llm.quality_rules import BASE, RULES, cascade_order, quality_filter, quality_verdicts
from retailmart.llm.textstats import TextStats
from retailmart.llm.toxicity import Lexicon, fit_toxicity, hits, score_toxicity


def brute_counts(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(sample, messy):
    for docs in (sample, messy):
        want = sorted(
            (str(r["doc_id"]), *(c := brute_counts(r["text"])), c[0] < 50 or 100 * c[4] > 50 * c[0]) for r in docs.collect()
        )
        rows = quality_verdicts(docs, counts=BASE).collect()
        assert sorted((str(r["doc_id"]), *(r[c] for c in BASE), r["base_failed"]) for r in rows) == want
        assert not any(r["kept"] and (r["base_failed"] or r["rejected_by"]) for r in rows)


def test_order_changes_no_verdict(messy, no_docs):
    order = cascade_order(messy)
    assert sorted(r.name for r in order) == sorted(r.name for r in RULES)
    texts = [r["text"] or "" for r in messy.collect()]
    kept = [not any(rule.rejects(TextStats(t.encode())) for rule in RULES) for t in texts]
    assert quality_filter(messy).count() == sum(kept)
    assert quality_filter(messy).columns == messy.columns
    assert quality_filter(no_docs).collect() == quality_verdicts(no_docs).collect() == []


def test_rules_keep_clean_documents(spark, labels):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = quality_verdicts(docs, counts=("n_words",)).join(labels, "doc_id").collect()
    assert not [r["doc_id"] for r in found if r["quality"] == 1 and not r["base_failed"] and not r["kept"]]
    assert sum(r["kept"] for r in found if r["quality"] == 0) <= 0.2 * sum(r["quality"] == 0 for r in found)


def brute_pairs(docs, items, threshold=0.8):
    def shingles(text, n):
        words = re.findall(r"\w+", (text or "").lower())
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}

    out = set()
    for item_id, text in items:
        n = min(5, len(re.findall(r"\w+", text or "")))
        own = shingles(text, n) if n else set()
        for doc_id, doc in docs:
            if own and len(own & shingles(doc, n)) >= threshold * len(own):
                out.add((doc_id, item_id))
    return out


@pytest.mark.parametrize("block_bytes", [16_000_000, 3000])
def test_containment_equals_brute_force(spark, sample, block_bytes):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    texts = [tuple(r) for r in bench.select("item_id", "text").collect()]
    words = texts[0][1].split()
    extra = [
        (9001, "before " + " ".join(words) + " after"),
        (9002, " ".join(w if i != len(words) // 2 else "CHANGED" for i, w in enumerate(words))),
        (9003, " ".join(words[: len(words) // 2])),
        (9004, "A, Short one!"),
        (9005, None),
    ]
    items = bench.select("item_id", "text").unionByName(
        spark.createDataFrame([(501, "short ONE"), (502, None), (503, ""), (None, texts[1][1]), (501, "short ONE")], "item_id long, text string")
    )
    docs = sample.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = contained_items(docs, items, block_bytes=block_bytes).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    assert got == brute_pairs([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert len(rows) == len(got) and (9001, texts[0][0]) in got and (9004, 501) in got
    left = {r["doc_id"] for r in decontaminate(docs, items, block_bytes=block_bytes).collect()}
    assert left == {r["doc_id"] for r in docs.collect()} - {d for d, _ in got}


def test_an_index_takes_few_times_its_items(sample):
    """The shingles are cut when they are needed: what is sent and held grows with the texts alone."""
    import pickle
    import tracemalloc

    items = [(k, r["text"]) for k, r in enumerate(sample.collect()) if r["text"]]
    size = sum(len(t.encode()) for _, t in items)
    tracemalloc.start()
    index = ItemIndex(items, 5, 0.8)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert size > 100_000 and held < 7 * size
    assert len(pickle.dumps(index.sent())) < 6 * size
    again = ItemIndex.received(pickle.loads(pickle.dumps(index.sent())))
    for item_id, text in items[:20]:
        assert item_id in {k for k, _, _ in again.found_in(text)}


def test_containment_of_odd_tables(messy, no_docs, spark):
    items = messy.select(F.col("doc_id").alias("item_id"), "text")
    assert contained_items(messy, items).count() > 0
    assert decontaminate(messy, items).columns == messy.columns
    assert contained_items(no_docs, items).collect() == decontaminate(no_docs, items).collect() == []
    assert contained_items(messy, items.limit(0)).collect() == []
    assert decontaminate(messy, items.limit(0)).count() == messy.count()


def test_quality_on_held_out_rows(spark, labels, messy, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit_quality(docs, labels)
    found = [r for r in score_quality(docs, model).join(labels, "doc_id").collect() if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in found) >= 0.95 * len(found)
    assert all(0 <= r["score"] <= 1 for r in score_quality(messy, model).collect())
    assert score_quality(no_docs, model).collect() == []
    assert score_quality(messy, fit_quality(docs, labels.limit(0))).count() == messy.count()


def test_toxicity_on_held_out_rows(spark, labels, messy, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    more = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = fit_toxicity(docs, more)
    found = [r for r in score_toxicity(docs, model).join(more, "doc_id").collect() if r["held_out"]]
    assert sum(r["predicted"] == r["toxic"] for r in found) >= 0.95 * len(found)
    assert score_toxicity(messy, model).count() == messy.count()
    assert score_toxicity(no_docs, model).collect() == []
    assert score_toxicity(messy, fit_toxicity(docs, more.limit(0))).count() == messy.count()


def test_the_automaton_equals_edit_distance():
    terms = ["idiot", "scum", "pathetic", "worthless", "trash", "disgustingly"]
    lexicon = Lexicon(terms)

    def distance(word: str, term: str) -> int:
        """Edits from term to word; those of the term's first letter count double, unless a digit stands for it."""
        row = [0] + [j + 1 for j in range(1, len(term) + 1)]
        for x in word:
            out = [row[0] + 2]
            for j, y in enumerate(term, 1):
                left_out = out[j - 1] + (2 if j == 1 else 1)
                other = row[j - 1] + (0 if x == y else 2 if j == 1 and not x.isdigit() else 1)
                out.append(min(row[j] + 1, left_out, other))
            row = out
        return row[-1]

    words = {t[:i] + c + t[i + d :] for t in terms for i in range(len(t) + 1) for c in ("", "x", "xx", "1", "1x") for d in (0, 1, 2)} | {"", "the"}
    allowed = {t: 0 if len(t) < 5 else 1 if len(t) < 12 else 2 for t in terms}
    for w in words:
        near = [(distance(w, t), t) for t in terms if distance(w, t) <= allowed[t]]
        assert lexicon.match(w) == (min(near) if near else None), w


def test_quotation_is_told_from_abuse():
    lexicon = Lexicon(["idiot"])
    assert hits('He wrote "idiot" there', lexicon, {}) == {"exact_quoted": 1}
    assert hits("the word idiot is old", lexicon, {}) == {"exact_quoted": 1}
    assert hits("you are an idoit? an id1ot", lexicon, {}) == {"near_addressed": 1}
    assert hits("what an idiot he is", lexicon, {}) == {"exact": 1}


def test_one_text_makes_no_word_known(spark):
    """A misspelling quoted once in a text that is not toxic stays a hit; a proper word found in several does not."""
    import random

    draw = random.Random(3)
    fill = lambda i: " ".join(f"w{draw.randrange(400)}" for _ in range(12))
    texts = [(f"you stupid {fill(i)}", 1) for i in range(60)] + [(fill(i), 0) for i in range(300)]
    texts += [(f"he wrote stupit {fill(1)}", 0)] + [(f"the stupic {fill(i * 13)}", 0) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id long, toxic int")
    model = fit_toxicity(docs, labels)
    assert "stupid" in model.terms and "stupit" not in model.known and "stupic" in model.known


def test_terms_masked_by_a_sign():
    lexicon = Lexicon(["idiot", "stupid"])
    assert hits("what an id*ot he is", lexicon, {}) == {"near": 1}
    assert hits("you st@pid one", lexicon, {}) == {"near_addressed": 1}
    assert hits("that idiot-like well-known thing", lexicon, {}) == {"exact": 1}
    assert hits('the "stu-pid" there', lexicon, {}) == {"near_quoted": 1}
    assert hits("you are an i.d.i.o.t", lexicon, {}) == {"near_addressed": 1}
    assert hits("you id\u200biot", lexicon, {}) == {"exact_addressed": 1}


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ('He wrote "you are an idiot" yesterday', "exact_quoted"),
        ('"What an idiot!" she reported', "exact_quoted"),
        ("“you idiot”", "exact_quoted"),
        ("«vous êtes un idiot» a-t-elle dit", "exact_quoted"),
        ("„du idiot“ stand dort", "exact_quoted"),
        ("'you idiot' was written there", "exact"),
        ('a 5" screen, you idiot, and a 7" one', "exact_addressed"),
        ('"first" you idiot "second"', "exact_addressed"),
        ('an open " mark and you idiot', "exact_addressed"),
        ('"first line\nyou idiot" second', "exact_addressed"),
        ("it’s you, idiot, isn’t it", "exact_addressed"),
    ],
)
def test_passages_in_quote_marks(text, kind):
    assert hits(text, Lexicon(["idiot"]), {}) in ({kind: 1}, {kind + "_addressed": 1})


def test_masked_words_are_those_of_the_whole_pattern():
    import random

    from retailmart.llm.toxicity import MASKED, masked_words

    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("ab_é1*@.- ·") for _ in range(rng.randrange(25)))
        assert [m.span() for m in masked_words(text)] == [m.span() for m in MASKED.finditer(text)]


def test_pipeline_equals_its_stages(spark, tmp_path):
    """Against the documents that brute force leaves after the filters, and the laws of the last two stages."""
    from tests.llm.test_simhash import brute_print, roots

    sf = "/root/testdata/sf0.001"
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    docs = sorted(map(tuple, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()))
    docs = [d for d in docs if not any(r.rejects(TextStats((d[1] or "").encode())) for r in RULES)]
    first = roots([brute_print(t) for _, t in docs])
    docs = [d for k, d in enumerate(docs) if first[k] == k]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, _ in brute_pairs(docs, items)}
    rows = corpus_pipeline.run(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == [d for d, _ in docs if d not in bad]
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows)


def test_every_operator_has_a_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.queries())
    assert numbers == list(range(1, 14))
