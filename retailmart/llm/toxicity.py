"""Toxicity by a learned lexicon, misspellings included.

The lexicon holds the words that stand in toxic texts far more often than chance. Its trie is intersected with
Levenshtein automata: a state is the set of (trie node, edits so far) that a word's beginning can lead to, made when
it is first met, so a word is read once, letter by letter, and most words end after two or three. A window of words
around each hit tells quotation (quote marks around it or around the passage it stands in, words about words) from abuse
(address, exclamation). Counts of the kinds
of hits are weighed by a logistic model.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailmart.llm.labelled import TRAIN_ROWS, held_out, training_texts
from retailmart.llm.texts import doc_texts, kept, map_arrow, mixed, texts_of

WORD = re.compile(r"\w+")
#: Words that signs run through, as in ``id*ot`` or ``st@pid``; they are read whole, beside their pieces.
SIGNS = "*@$#%&+!|^~.·•-"
MASKED = re.compile(rf"\w+(?:[{re.escape(SIGNS)}]+\w+)+")
SIGN_INSIDE = re.compile(rf"(?<=\w)[{re.escape(SIGNS)}]+(?=\w)")
NO_SIGNS = str.maketrans("", "", SIGNS)
#: Characters that show nothing, put into words to hide them.
UNSEEN = re.compile("[\u00ad\u200b-\u200d\u2060\ufeff]")
#: Passages in quote marks, on one line; a mark inside a word or beside a blank it should hug is none.
QUOTE_CHARACTERS = 400
QUOTED = re.compile(
    r'(?<!\w)"(?=\S)[^"\n]{0,400}?(?<=\S)"(?!\w)|“[^“”\n]{0,400}”|„[^„“”\n]{0,400}[“”]|«[^«»\n]{0,400}»|»[^«»\n]{0,400}«|(?<!\w)[‘`](?=\S)[^‘`\n]{0,400}?(?<=\S)[’\'`](?!\w)'.replace(
        "400", str(QUOTE_CHARACTERS)
    )
)
#: Words on either side of a hit that are looked at.
WINDOW = 5
#: A word joins the lexicon if its log-likelihood ratio and its share of toxic texts reach these.
LEAST_RATIO, LEAST_SHARE = 24.0, 0.7
#: A word near a term is known as proper if its ratio against LEAST_SHARE reaches this: the 1 % level, as few words are
#: near a term. That takes three texts, none of them toxic.
LEAST_KNOWN = 6.63
KINDS = ("exact", "exact_quoted", "exact_addressed", "near", "near_quoted", "near_addressed")
SIGNALS = ("abuse", "amount", "near_only", "quoted_only", "addressed")
# Fixed word lists: address, and words about words.
ADDRESS = frozenset("you your youre u ur du dich dir ihr euch tu te toi vous ton eres usted tú ti".split())
MENTION = frozenset("word words term terms quote quoted said called spelled wort wörter begriff mot mots terme palabra término".split())
OPENING, CLOSING = "\"“”„«»‘’`", "\"“”«»‘’`"


def edits_allowed(term: str) -> int:
    """Short words are matched as they are; a second edit is for long ones, else it leads to other words."""
    return 0 if len(term) < 5 else 1 if len(term) < 12 else 2


def edit_cost(node: int, letter: str = "") -> int:
    """An edit at the beginning of a word, where the trie's root is, counts as two, as misspellings keep the first letter;
    a digit in its place counts as one."""
    return 1 if node or letter.isdigit() else 2


class Lexicon:
    """A trie of terms and the states of its intersection with Levenshtein automata, made as they are met."""

    def __init__(self, terms: list[str], known: frozenset[str] = frozenset()):
        #: ``known``: proper words that are near a term but not meant by it.
        self.known = known
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.most: list[int] = [0]
        for term in sorted(set(terms)):
            node = 0
            for c in term:
                self.most[node] = max(self.most[node], edits_allowed(term))
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.most.append(0)
                node = self.children[node][c]
            self.most[node] = max(self.most[node], edits_allowed(term))
            self.term[node] = term
        self.exact = frozenset(terms)
        self.states: dict[frozenset, int] = {}
        self.moves: list[dict[str, int]] = []
        self.sets: list[frozenset] = []
        self.accepts: list[tuple[int, str] | None] = []
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """The number of a state: left-out letters are followed, and of one node only the fewest edits stay."""
        queue = list(pairs)
        while queue:
            node, edits = queue.pop()
            missed = edits + edit_cost(node)
            for child in self.children[node].values():
                if missed <= self.most[child] and (child, missed) not in pairs:
                    pairs.add((child, missed))
                    queue.append((child, missed))
        least: dict[int, int] = {}
        for node, edits in pairs:
            least[node] = min(edits, least.get(node, edits))
        key = frozenset(least.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            ends = [(e, self.term[n]) for n, e in key if self.term[n] is not None and e <= edits_allowed(self.term[n])]
            self.accepts.append(min(ends) if ends else None)
        return self.states[key]

    def _move(self, state: int, letter: str) -> int:
        pairs = set()
        for node, edits in self.sets[state]:
            for c, child in self.children[node].items():
                cost = edits if c == letter else edits + edit_cost(node, letter)
                if cost <= self.most[child]:
                    pairs.add((child, cost))
            if edits + edit_cost(node) <= self.most[node]:
                pairs.add((node, edits + edit_cost(node)))
        to = self._state(pairs) if pairs else -1
        self.moves[state][letter] = to
        return to

    def match(self, word: str) -> tuple[int, str] | None:
        """(edits, term) of the nearest term that allows so many edits; ties go to the first in order."""
        if word in self.known:
            return None
        state = self.start
        for letter in word:
            to = self.moves[state].get(letter)
            if to is None:
                to = self._move(state, letter)
            if to < 0:
                return None
            state = to
        return self.accepts[state]


def seen(text: str) -> str:
    """The text in lower case, without characters that show nothing."""
    lower = text.lower()
    return UNSEEN.sub("", lower) if UNSEEN.search(lower) else lower


def masked_words(lower: str) -> list[re.Match]:
    """Words with signs inside: the few signs are looked for, and the word around each is read."""
    found: list[re.Match] = []
    upto = 0
    for sign in SIGN_INSIDE.finditer(lower):
        if sign.start() < upto:
            continue
        begin = sign.start()
        while begin > upto and (lower[begin - 1].isalnum() or lower[begin - 1] == "_"):
            begin -= 1
        word = MASKED.match(lower, begin)
        if word:
            found.append(word)
            upto = word.end()
    return found


def edits_of(word: str, lexicon: Lexicon) -> int:
    """The edits between a word and the nearest term that allows so many, or -1. Signs inside a word stand for a letter,
    or for nothing, which counts as one edit."""
    found = lexicon.match(word)
    if found is not None:
        return found[0]
    bare = word.translate(NO_SIGNS)
    return 1 if bare != word and bare in lexicon.exact and len(bare) > 4 else -1


def hits(text: str, lexicon: Lexicon, cache: dict[str, int]) -> Counter:
    """Numbers of hits by kind; ``cache`` has the edits (or -1) of words met before. A word with signs inside is a hit as
    a whole if none of its pieces is one. A hit is quoted if it stands in quote marks, or in a passage that does."""
    lower = seen(text)
    words = WORD.findall(lower)
    masked = masked_words(lower)
    for w in {*words, *(m[0] for m in masked)}.difference(cache):
        cache[w] = edits_of(w, lexicon)
    counts: Counter = Counter()
    at = [i for i, e in enumerate(map(cache.__getitem__, words)) if e >= 0]
    masked = [m for m in masked if cache[m[0]] >= 0]
    if not at and not masked:
        return counts
    spans = [m.span() for m in WORD.finditer(lower)]
    found = [(i, i, *spans[i], cache[words[i]]) for i in at]
    for m in masked:
        first, last = bisect_left(spans, m.span()[:1]), bisect_left(spans, (m.end(),)) - 1
        if all(cache[w] < 0 for w in words[first : last + 1]):
            found.append((first, last, *m.span(), cache[m[0]]))
    quotes = [m.span() for m in QUOTED.finditer(lower)]
    opened = [a for a, _ in quotes]
    for first, last, begin, end, edits in found:
        around = words[max(0, first - WINDOW) : last + WINDOW + 1]
        quoted = lower[begin - 1 : begin] in set(OPENING) and lower[end : end + 1] in set(CLOSING)
        inside = bisect_left(opened, begin) - 1
        quoted = quoted or inside >= 0 and end <= quotes[inside][1] or not MENTION.isdisjoint(around)
        addressed = not ADDRESS.isdisjoint(around) or lower[end : end + 1] == "!"
        kind = "exact" if edits == 0 else "near"
        counts[kind + ("_quoted" if quoted else "_addressed" if addressed else "")] += 1
    return counts


def signals(counts: Counter) -> list[float]:
    """What the score is made of. A misspelled term weighs as much as a proper one but for what ``near_only`` learns."""
    proper = counts["exact"] + counts["exact_addressed"]
    abuse = proper + counts["near"] + counts["near_addressed"]
    quoted = counts["exact_quoted"] + counts["near_quoted"]
    addressed = counts["exact_addressed"] + counts["near_addressed"]
    return [float(abuse > 0), float(np.log1p(abuse)), float(abuse > 0 and not proper), float(quoted > 0 and not abuse), float(addressed > 0)]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    """Weights by Newton's method; the first column, the base rate, is not shrunk."""
    weights = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[0] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (y - p) - shrink * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink)
        weights = weights + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return weights


def without_copies(texts: DataFrame) -> DataFrame:
    """Training texts without near copies: of texts with one label that share a MinHash of their five-word shingles, the
    one with the smallest id stays, for three MinHashes in turn. Else the rare words of a much copied text look like
    terms."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in texts_of(batch.column("text")):
            words = text.lower().split()
            shingles = {xxhash.xxh64_intdigest(b" ".join(words[i : i + 5])) for i in range(max(1, len(words) - 4))}
            hashes = np.fromiter(shingles, np.uint64, len(shingles))
            rows.append([int(mixed(hashes * np.uint64(2 * k + 3)).view(np.int64).min()) for k in range(3)])
        columns = [pa.array(x, pa.int64()) for x in zip(*rows)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *columns], ["doc_id", "label", "s0", "s1", "s2"])

    signed = map_arrow(texts, work, "doc_id long, label int, s0 long, s1 long, s2 long")
    for k in range(3):
        signed = signed.groupBy("label", f"s{k}").agg(F.min(F.struct("doc_id", "s0", "s1", "s2")).alias("row")).select("label", "row.*")
    return texts.join(signed.select("doc_id").distinct(), "doc_id", "left_semi")


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, toxic texts, all texts) over training texts; words with signs inside are counted whole as well."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        toxic, total = Counter(), Counter()
        for label, text in zip(batch.column("label").to_pylist(), texts_of(batch.column("text"))):
            lower = seen(text.decode())
            own = {*WORD.findall(lower), *(m[0] for m in masked_words(lower))}
            total.update(own)
            if label:
                toxic.update(own)
        rows = [list(total), [toxic[w] for w in total], list(total.values())]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, (pa.string(), pa.int64(), pa.int64()))], ["word", "toxic", "total"])

    found = map_arrow(texts, work, "word string, toxic long, total long")
    return found.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("total").alias("total"))


class Model:
    """A lexicon's terms, the proper words near them, and the weights of the signals."""

    def __init__(self, terms: list[str], known: list[str], weights: list[float]):
        self.terms, self.known, self.weights = terms, known, weights


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS, **columns) -> Model:
    """Learn lexicon and weights from at most ``rows`` labelled documents.

    To the driver come the numbers of texts, the terms, the proper words near a term, and one row of counts per
    training text: all bounded by the sample. Without toxic texts the lexicon is empty.
    """
    texts = kept(training_texts(docs, labels, label, rows, **columns), "toxicity-training")
    alone = kept(without_copies(texts), "toxicity-alone")
    counted = kept(word_counts(alone), "toxicity-words")
    total, toxic = alone.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    rate = (toxic + 0.5) / (total + 1)
    t, n = F.col("toxic").cast("double"), F.col("total").cast("double")
    chosen = counted.where((_ratio(t, n, rate) >= LEAST_RATIO) & (t / n >= LEAST_SHARE) & (F.length("word") > 2)).select("word")
    terms = sorted(r["word"] for r in chosen.collect())
    # A misspelled term would have a term's share; one quotation or wrong label does not tell otherwise.
    near = _near_words(counted.where((_ratio(t, n, LEAST_SHARE) >= LEAST_KNOWN) & (t / n < LEAST_SHARE)), terms)
    known = sorted(r["word"] for r in near.collect() if r["word"] not in set(terms))
    found = sorted(_hit_rows(texts, terms, known).collect(), key=lambda r: (r["doc_id"], r["label"], r["signals"]))
    x = np.array([[1.0, *r["signals"]] for r in found]).reshape(len(found), len(SIGNALS) + 1)
    y = np.array([r["label"] for r in found], np.float64)
    return Model(terms, known, fit_logistic(x, y).tolist())


def _ratio(toxic: Column, total: Column, share: float) -> Column:
    """Log-likelihood ratio of a word's own share of toxic texts against ``share``."""
    part = lambda k, expected: F.when(k > 0, k * F.log(k / (total * expected))).otherwise(0.0)
    return 2 * (part(toxic, share) + part(total - toxic, 1 - share))


def _near_words(words: DataFrame, terms: list[str]) -> DataFrame:
    def run(batches):
        lexicon = Lexicon(terms)
        for batch in batches:
            near = [lexicon.match(w) is not None for w in batch.column("word").to_pylist()]
            yield batch.select(["word"]).filter(pa.array(near, pa.bool_()))

    return words.select("word").mapInArrow(run, "word string")


def _hit_rows(texts: DataFrame, terms: list[str], known: list[str]) -> DataFrame:
    def run(batches):
        lexicon, cache = Lexicon(terms, frozenset(known)), {}
        for batch in batches:
            rows, totals = [], []
            for text in texts_of(batch.column("text")):
                counts = hits(text.decode(), lexicon, cache)
                rows.append(signals(counts))
                totals.append(counts.total())
                if len(cache) > CACHE_WORDS:
                    cache.clear()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.list_(pa.float64())), pa.array(totals, pa.int64())], HIT_COLUMNS)

    return texts.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, signals array<double>, hits long")


HIT_COLUMNS = ["doc_id", "label", "signals", "hits"]
#: Words that a task remembers the verdict of; then it starts anew.
CACHE_WORDS = 300_000


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, hits), one row per input row; ``hits`` counts terms, misspelled ones included.

    Only the text makes the score; null and empty texts have no hits. An empty table gives no rows.
    """
    found = _hit_rows(doc_texts(docs, id_col, text_col).withColumn("label", F.lit(0)), model.terms, model.known)
    # The first weight stands outside Spark's exponential, whose last bit may differ from Python's: without hits the score is exact.
    total = F.lit(0.0)
    for k, weight in enumerate(model.weights[1:]):
        total = total + F.lit(float(weight)) * F.col("signals")[k]
    score = 1 / (1 + F.lit(math.exp(-model.weights[0])) * F.exp(-total))
    scored = found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), "hits")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "hits")
