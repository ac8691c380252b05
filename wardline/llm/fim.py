"""Fill-in-the-middle training texts by secondary sort.

A text's units (lines) are dealt to prefix, middle and suffix. Chunks of units leave the scan as pieces
keyed by row and output position; one exchange on the row and a sort by position bring a text's output
together piece by piece, so a text is streamed and never held whole. The original comes back from the
output alone: its pieces are sorted again, in the same partition, by the place their section has there.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a piece, unless one row's markers make it longer, and of a batch that is handed on.
PIECE, BATCH = 32_768, 4 << 20
PLAIN, PSM, SPM = "plain", "psm", "spm"


class Plan(NamedTuple):
    """How texts are rearranged: percent of texts rearranged, percent of those with the suffix first."""
    seed: int = 7
    rate: int = 100
    suffix_first: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    @property
    def marks(self) -> tuple[bytes, bytes, bytes]:
        """Markers in the order of the original text's sections."""
        return self.prefix.encode(), self.middle.encode(), self.suffix.encode()


_HEAD = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
         ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
_PIECES = [("row", pa.int64()), ("place", pa.int64()), ("data", pa.binary()), *_HEAD]
_RESTORE = [("row", pa.int64()), ("place", pa.int64()), ("data", pa.binary()), *_HEAD, ("output_sha256", pa.string())]
_DIGESTS = [*_HEAD, ("output_sha256", pa.string()), ("restored_sha256", pa.string())]
_TEXTS = [*_HEAD, ("output", pa.string())]
_DDL = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}


def _ddl(fields) -> str:
    return ", ".join(f"{name} {_DDL[kind]}" for name, kind in fields)


class _Rows:
    """Rows gathered into record batches of some megabytes."""

    def __init__(self, fields):
        self.fields = fields
        self._clear()

    def _clear(self):
        self.columns, self.size = [[] for _ in self.fields], 0

    def add(self, values, size: int = 64) -> bool:
        for column, value in zip(self.columns, values):
            column.append(value)
        self.size += size
        return self.size >= BATCH

    def take(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(self.columns, self.fields)],
                                         [name for name, _ in self.fields])
        self._clear()
        return out


def unit_ends(data: np.ndarray) -> np.ndarray:
    """Byte offsets behind every line; the last line may lack its line feed."""
    ends = np.flatnonzero(data == 10) + 1
    if len(data) and (not len(ends) or ends[-1] < len(data)):
        ends = np.append(ends, len(data))
    return ends


def chunks(ends: np.ndarray, start: int, stop: int):
    """Runs of whole units of at most ``PIECE`` bytes; a longer unit is cut."""
    while start < stop:
        k = int(np.searchsorted(ends, start + PIECE, "right"))
        end = int(ends[k - 1]) if k and ends[k - 1] > start else start + PIECE
        end = min(end, stop)
        yield start, end
        start = end


def arranged(doc_id: int | None, text: bytes, plan: Plan):
    """The head ``(n, form, prefix_chars, middle_chars)`` of a text, and its output's pieces in order."""
    data = np.frombuffer(text, np.uint8)
    ends = unit_ends(data)
    n = len(ends)
    digest = hashlib.sha256(f"{plan.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or h3 % 100 >= plan.rate or any(m in text for m in plan.marks):
        return (n, PLAIN, None, None), [text[a:b] for a, b in chunks(ends, 0, len(text))] or [b""]
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, q = (int(ends[k - 1]) if k else 0 for k in (first, second))
    sections = {plan.marks[0]: (0, p), plan.marks[1]: (p, q), plan.marks[2]: (q, len(text))}
    form = SPM if h4 % 100 < plan.suffix_first else PSM
    pre, mid, suf = plan.marks
    pieces = []
    for mark in (suf, pre, mid) if form == SPM else (pre, suf, mid):
        parts = [text[a:b] for a, b in chunks(ends, *sections[mark])] or [b""]
        parts[0] = mark + parts[0]
        pieces += parts
    begins = (data & 0xC0) != 0x80
    return (n, form, int(begins[:p].sum()), int(begins[p:q].sum())), pieces


def _emit(plan: Plan):
    def run(batches):
        rows = _Rows(_PIECES)
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(i) for i in range(3))):
                text = (text.as_py() or "").encode()
                head, pieces = arranged(doc_id.as_py(), text, plan)
                for place, piece in enumerate(pieces):
                    if rows.add((row.as_py(), place, piece, doc_id.as_py(), *(head if not place else (None,) * 4)), 64 + len(piece)):
                        yield rows.take()
        yield rows.take()
    return run


def _columns(batch) -> zip:
    return zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))


def _split_output(plan: Plan):
    """Digests every output as its pieces pass; hands on the pieces with their place in the original.

    Only the output and the form are read: a piece that begins with a marker opens the marker's section.
    """
    def run(batches):
        rows, now, head, digest, section = _Rows(_RESTORE), None, None, None, 0
        def done():
            return (now, -1, None, *head, digest.hexdigest())
        for batch in batches:
            for row, place, data, *values in _columns(batch):
                if row != now:
                    if now is not None and rows.add(done(), 200):
                        yield rows.take()
                    now, head, digest, section = row, values, hashlib.sha256(), 0
                digest.update(data)
                for k, mark in enumerate(plan.marks if head[2] != PLAIN else ()):
                    if data.startswith(mark):
                        section, data = k, data[len(mark):]
                        break
                if rows.add((row, (section << 48) + place, data, *(None,) * 6), 64 + len(data)):
                    yield rows.take()
        if now is not None:
            rows.add(done())
        yield rows.take()
    return run


def _restored(batches):
    rows, now, head, digest = _Rows(_DIGESTS), None, None, None
    for batch in batches:
        for row, place, data, *values in _columns(batch):
            if row != now:  # the head comes first, at place -1
                if now is not None and rows.add((*head, digest.hexdigest()), 300):
                    yield rows.take()
                now, head, digest = row, values, hashlib.sha256()
            if place >= 0:
                digest.update(data)
    if now is not None:
        rows.add((*head, digest.hexdigest()))
    yield rows.take()


def _joined(batches):
    rows, now, head, parts = _Rows(_TEXTS), None, None, []
    for batch in batches:
        for row, _, data, *values in _columns(batch):
            if row != now:
                if now is not None and rows.add((*head, b"".join(parts).decode()), 64 + sum(map(len, parts))):
                    yield rows.take()
                now, head, parts = row, values, []
            parts.append(data)
    if now is not None:
        rows.add((*head, b"".join(parts).decode()))
    yield rows.take()


def fim_pieces(df: DataFrame, key: str = "doc_id", text: str = "text", plan: Plan = Plan()) -> DataFrame:
    """The rearranged texts as pieces ``(row, place, data, doc_id, n, form, prefix_chars, middle_chars)``.

    Every row of ``df`` is a text of its own, also where keys repeat; ``row`` tells them apart. Pieces of a
    row are in one partition, rows one after the other, pieces in order of their place in the output;
    ``n`` (lines) and the following columns stand at place 0. Null and empty texts give one empty piece and are plain; a
    text that holds a marker is plain; a null key hashes as no digits. An empty table gives no rows;
    other columns are not read.
    """
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_emit(plan), _ddl(_PIECES)).repartition("row").sortWithinPartitions("row", "place")


def fim_texts(df: DataFrame, key: str = "doc_id", text: str = "text", plan: Plan = Plan()) -> DataFrame:
    """``(key, n, form, prefix_chars, middle_chars, output)``: one row for every row of ``df``, with the whole output.
    Edge cases as in ``fim_pieces``."""
    out = fim_pieces(df, key, text, plan).mapInArrow(_joined, _ddl(_TEXTS))
    return out.withColumnRenamed("doc_id", key)


def fim_digests(df: DataFrame, key: str = "doc_id", text: str = "text", plan: Plan = Plan()) -> DataFrame:
    """``(key, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)`` for every row of ``df``.

    The second digest is of the text rebuilt from output and form. Texts are streamed through both sorts,
    in one exchange. Edge cases as in ``fim_pieces``.
    """
    split = fim_pieces(df, key, text, plan).mapInArrow(_split_output(plan), _ddl(_RESTORE))
    out = split.sortWithinPartitions("row", "place").mapInArrow(_restored, _ddl(_DIGESTS))
    return out.withColumnRenamed("doc_id", key)
