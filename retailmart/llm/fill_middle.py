"""Fill in the middle: prefix, suffix and middle of a text change places behind markers.

Every byte of a batch moves by an amount that changes only at cuts. The changes go into a difference array, its running
sum is the shift of each byte, and one scatter writes all texts of the batch. The way back finds the markers and gathers
each byte from its place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from retailmart.llm.texts import buffer_of, doc_texts, map_arrow

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3
#: Of 100 texts, those left plain, and of the others those with the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
#: Bytes that are moved at once, so that a long text needs little beside its input and output.
WINDOW = 1 << 20

FORMS = np.array(["plain", "psm", "spm"])


def marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of markers in a batch and the letter of each. A marker may run over the end of a text."""
    if len(data) < MARK:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    at = np.flatnonzero(data[:-2] == ord("<"))
    letter = data[at + 1]
    hit = (data[at + 2] == ord(">")) & ((letter == ord("P")) | (letter == ord("S")) | (letter == ord("M")))
    return at[hit], letter[hit]


def _inside(at: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text of each marker, and whether it ends there too."""
    doc = np.searchsorted(offsets, at, "right") - 1
    return doc, at + MARK <= offsets[doc + 1]


def moved(data: np.ndarray, cuts: np.ndarray, shifts: np.ndarray, move: Callable[[slice, np.ndarray], None]) -> None:
    """Call ``move(window, places)`` for each stretch of bytes: ``shifts[k]`` holds from ``cuts[k]`` (sorted) on."""
    steps = np.diff(shifts, prepend=0)
    carry, done = 0, 0
    for a in range(0, len(data), WINDOW):
        b = min(a + WINDOW, len(data))
        upto = int(np.searchsorted(cuts, b))
        change = np.zeros(b - a, np.int64)
        np.add.at(change, cuts[done:upto] - a, steps[done:upto])
        change[0] += carry
        shift = np.cumsum(change)
        carry, done = int(shift[-1]), upto
        move(slice(a, b), np.arange(a, b) + shift)


class CodePoints:
    """Code points of the texts of a batch; places are found through counts of ``BLOCK`` bytes each, not of each byte."""

    BLOCK = 1 << 12

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.starts, self.offsets = (data & 0xC0) != 0x80, offsets
        self.n = np.zeros(len(offsets) - 1, np.int64)
        filled = offsets[1:] > offsets[:-1]
        if filled.any():
            self.n[filled] = np.add.reduceat(self.starts, offsets[:-1][filled], dtype=np.int64)
        self.ahead = np.append(0, np.cumsum(self.n))  # code points before each text
        blocks = np.arange(0, len(data), self.BLOCK)
        counts = np.add.reduceat(self.starts, blocks, dtype=np.int64) if len(blocks) else np.zeros(0, np.int64)
        self.before = np.append(0, np.cumsum(counts))

    def bytes_of(self, units: np.ndarray) -> np.ndarray:
        """The bytes that the first ``units`` code points of each text take."""
        out = np.diff(self.offsets)
        wanted = self.ahead[:-1] + units
        block = np.searchsorted(self.before, wanted, "right") - 1
        for k in np.flatnonzero(units < self.n):
            a = int(block[k]) * self.BLOCK
            places = np.flatnonzero(self.starts[a : a + self.BLOCK])
            out[k] = a + places[wanted[k] - self.before[block[k]]] - self.offsets[k]
        return out


def draws(ids: list[int | None]) -> np.ndarray:
    """Four numbers a document: the first 8-digit groups of the hex SHA-256 of ``1:`` and the id (nothing for null)."""
    raw = b"".join(hashlib.sha256(b"1:" + (b"" if i is None else b"%d" % i)).digest()[:16] for i in ids)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


def scattered(data: np.ndarray, offsets: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """(bytes, offsets, facts) of the outputs of a batch of texts."""
    points = CodePoints(data, offsets)
    n = points.n
    at, _ = marks(data)
    doc, whole = _inside(at, offsets)
    marked = np.zeros(len(n), bool)
    marked[doc[whole]] = True
    plain = (n == 0) | marked | (h[:, 2] % 100 >= 100 - PLAIN)
    spm = ~plain & (h[:, 3] % 100 < SUFFIX_FIRST)
    one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    low, high = np.minimum(one, two), np.maximum(one, two)

    size = np.diff(offsets)
    p = points.bytes_of(low)
    m = points.bytes_of(high) - p
    s = size - p - m
    out_offsets = np.append(0, np.cumsum(size + np.where(plain, 0, 3 * MARK)))
    base = out_offsets[:-1] - offsets[:-1]
    # How far prefix, middle and suffix move within their text.
    shift_p = np.select([plain, spm], [0, s + 2 * MARK], MARK)
    shift_m = np.select([plain, spm], [0, s + 3 * MARK], s + 3 * MARK)
    shift_s = np.select([plain, spm], [0, MARK - p - m], 2 * MARK - m)
    cuts = np.column_stack([offsets[:-1], offsets[:-1] + p, offsets[:-1] + p + m]).ravel()
    shifts = (np.column_stack([shift_p, shift_m, shift_s]) + base[:, None]).ravel()
    # Of several cuts at one byte, the last holds.
    last = np.append(cuts[1:] != cuts[:-1], True) if len(cuts) else np.zeros(0, bool)

    out = np.empty(out_offsets[-1], np.uint8)

    def scatter(window: slice, places: np.ndarray) -> None:
        out[places] = data[window]

    moved(data, cuts[last], shifts[last], scatter)
    head = out_offsets[:-1]
    for marker, psm_at, spm_at in ((PREFIX, 0 * p, s + MARK), (SUFFIX, p + MARK, 0 * p), (MIDDLE, p + s + 2 * MARK, p + s + 2 * MARK)):
        place = (head + np.where(spm, spm_at, psm_at))[~plain]
        for k in range(MARK):
            out[place + k] = marker[k]
    facts = {"n": n, "form": FORMS[np.where(plain, 0, np.where(spm, 2, 1))], "prefix": low, "middle": high - low, "plain": plain}
    return out, out_offsets, facts


def gathered(data: np.ndarray, offsets: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts that outputs were made from; markers are looked for where the form is not plain."""
    at, letter = marks(data)
    doc, whole = _inside(at, offsets)
    real = whole & ~plain[doc]
    at, letter, doc = at[real], letter[real], doc[real]
    where = np.zeros((len(plain), 3), np.int64)
    for k, name in enumerate((PREFIX, SUFFIX, MIDDLE)):
        own = letter == name[1]
        where[doc[own], k] = at[own]
    sizes = np.diff(offsets)
    text_offsets = np.append(0, np.cumsum(sizes - np.where(plain, 0, 3 * MARK)))
    p_at, s_at, m_at = where.T
    end = offsets[1:]
    spm = s_at < p_at
    p = np.where(plain, 0, np.where(spm, m_at, s_at) - p_at - MARK)
    m = np.where(plain, 0, end - m_at - MARK)
    s = np.where(plain, 0, np.where(spm, p_at, m_at) - s_at - MARK)
    begin = text_offsets[:-1]
    cuts = np.column_stack([begin, begin + p, begin + p + m]).ravel()
    sources = np.column_stack([p_at + MARK, m_at + MARK, s_at + MARK])
    sources[plain] = offsets[:-1][plain, None]
    shifts = (sources - np.column_stack([begin, begin + p, begin + p + m])).ravel()
    # A plain text is one piece from its start; elsewhere the last of several cuts at one byte holds.
    last = np.append(cuts[1:] != cuts[:-1], True) if len(cuts) else np.zeros(0, bool)
    out = np.empty(text_offsets[-1], np.uint8)

    def gather(window: slice, places: np.ndarray) -> None:
        out[window] = data[places]

    moved(out, cuts[last], shifts[last], gather)
    return out, text_offsets


def _texts(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    if len(data) >= 2**31:
        raise ValueError("a batch of outputs passes 2 GB, the most that one Arrow text column holds")
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text in its form for training: doc_id, n, form, prefix_chars, middle_chars, output.

    ``psm`` is prefix, suffix, middle; ``spm`` has the suffix first; ``plain`` is the text itself, for empty and null
    texts, texts that hold a marker, and a tenth of the others. Cuts and form depend on the id alone, so rows that repeat
    give equal outputs; a null id draws as an id without digits. ``n`` counts code points; the two lengths are null
    where plain. One row out for each row in, no shuffle; columns beside id and text are not read.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("doc_id")
        out, offsets, facts = scattered(*buffer_of(batch.column("text")), draws(ids.to_pylist()))
        lengths = [pa.array(facts[c], pa.int64(), mask=facts["plain"]) for c in ("prefix", "middle")]
        columns = [ids, pa.array(facts["n"]), pa.array(facts["form"].tolist(), pa.string()), *lengths, _texts(out, offsets)]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in OUTPUT.split(", ")])

    return map_arrow(doc_texts(docs, id_col, text_col), work, OUTPUT)


def restored(outputs: DataFrame) -> DataFrame:
    """The rows of ``fill_in_middle`` with ``text``, rebuilt from ``form`` and ``output`` alone."""
    names = outputs.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        plain = np.array([f == "plain" for f in batch.column("form").to_pylist()], bool)
        text = _texts(*gathered(*buffer_of(batch.column("text")), plain))
        same = [batch.column("text" if c == "output" else c) for c in names]
        return pa.RecordBatch.from_arrays([*same, text], [*names, "text"])

    renamed = outputs.withColumnRenamed("output", "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema.fields)
    return map_arrow(renamed, work, f"{schema}, text string")
