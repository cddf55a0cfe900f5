"""Fill-in-the-middle: cut documents into pieces and put them into output order by a secondary sort.

One task cuts a document into pieces of bounded size, keyed by document and output position. A shuffle by document with a
sort inside each partition (`repartition` and `sortWithinPartitions`: Spark SQL's repartitionAndSortWithinPartitions, which
spills to disk) brings them into output order; one pass streams them into the output's digest, reads the control strings
back out of the stream and gives each piece its place in the original. A second sort inside the same partitions, without a
shuffle, streams the restored text into its digest. No pass holds more than a piece and an Arrow batch of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bounded_batches, carried

#: Control strings before prefix, suffix and middle; fixed values.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Order of the parts in the output of each form; the original has them as prefix, middle, suffix.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
#: Bytes of a piece at most.
PIECE = 1 << 16
#: Bytes and rows handed on at once.
FLUSH, ROWS = 4 << 20, 10_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_FACTS = "n bigint, form string, prefix_chars bigint, middle_chars bigint"


def _unit_starts(raw: np.ndarray) -> np.ndarray:
    """Where units begin, in bytes: runs of ASCII letters, and every other code point for itself."""
    letter = _LETTER[raw]
    inside = (raw & 0xC0) == 0x80
    inside[1:] |= letter[1:] & letter[:-1]
    return np.flatnonzero(~inside)


def _chars(raw: np.ndarray) -> int:
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def _cuts(starts: np.ndarray, raw: np.ndarray, begin: int, end: int, size: int) -> list[int]:
    """Ends of pieces of [begin, end): at unit starts; inside a unit, at a code point, only where it is longer than a piece."""
    out = []
    while end - begin > size:
        k = int(np.searchsorted(starts, begin + size, "right")) - 1
        cut = int(starts[k])
        if cut <= begin:
            cut = begin + size
            while raw[cut] & 0xC0 == 0x80:
                cut -= 1
        out.append(cut)
        begin = cut
    return [*out, end]


def _pieces(text: bytes, h: list[int], size: int) -> tuple[tuple, list[bytes]]:
    """((n, form, prefix_chars, middle_chars), pieces in output order)."""
    raw = np.frombuffer(text, np.uint8)
    starts = _unit_starts(raw)
    n = len(starts)
    if not n or h[2] % 100 >= 90 or any(c in text for c in PLACE):
        return (n, "plain", None, None), [text[a:b] for a, b in _spans(starts, raw, 0, len(text), size)]
    form = "spm" if h[3] % 100 < 20 else "psm"
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    at = np.append(starts, len(text))
    a, b = int(at[first]), int(at[second])
    parts = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, len(text))}
    pieces = []
    for mark in FORMS[form]:
        spans = _spans(starts, raw, *parts[mark], size)
        pieces += [mark + text[x:y] if k == 0 else text[x:y] for k, (x, y) in enumerate(spans)]
    return (n, form, _chars(raw[:a]), _chars(raw[a:b])), pieces


def _spans(starts: np.ndarray, raw: np.ndarray, begin: int, end: int, size: int) -> list[tuple[int, int]]:
    ends = _cuts(starts, raw, begin, end, size)
    return list(zip([begin, *ends[:-1]], ends))


class _Out:
    """Rows collected into batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, row: tuple, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.bytes += size
        if self.bytes >= FLUSH or len(self.rows) >= ROWS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)], schema=self.schema)
        self.rows, self.bytes = [], 0


def fim_pieces(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = PIECE) -> DataFrame:
    """(row, position, doc_id, n, form, prefix_chars, middle_chars, piece): the outputs of all documents in pieces.

    `row` numbers the rows of `docs` (read twice, after a lost task, they must come in the same order, as those of a
    stored table do), so that rows that repeat an id or a text stay apart. The pieces of a row, put in order of
    `position`, are its output; n to middle_chars are set on position 0 only. A null or empty text has one empty
    piece of form plain; a null id counts as '' where it is hashed. Other columns are ignored, an empty table gives none.
    """
    bounded_batches(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    group = lambda k: F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long")
    rows = carried(docs, id, text).withColumn("digest", digest).withColumn("row", F.monotonically_increasing_id())
    rows = rows.select("row", "doc_id", "text", F.array(*[group(k) for k in range(4)]).alias("h"))
    out = f"row bigint, position int, doc_id bigint, {_FACTS}, piece binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _Out(_arrow(out))
        for batch in batches:
            columns = [batch.column("row"), batch.column("doc_id"), batch.column("text").cast(pa.binary()), batch.column("h")]
            for row, doc, raw, h in zip(*columns):
                facts, pieces = _pieces(raw.as_py() or b"", h.as_py(), size)
                for k, piece in enumerate(pieces):
                    head = (doc.as_py(), *facts) if k == 0 else (None,) * 5
                    yield from kept.add((row.as_py(), k, *head, piece), len(piece))
        yield from kept.flush()

    return rows.mapInArrow(run, out)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def in_order(pieces: DataFrame) -> DataFrame:
    """Each document's pieces in one partition, in output order."""
    return pieces.repartition("row").sortWithinPartitions("row", "position")


class _Reader:
    """Finds the control strings of a form in a stream of pieces; what lies between belongs to a part."""

    def __init__(self, form: str):
        self.marks, self.place, self.rest = list(FORMS.get(form, ())), 0, b""

    def read(self, piece: bytes) -> Iterator[tuple[int, bytes]]:
        data = self.rest + piece
        self.rest = b""
        while self.marks:
            k = data.find(self.marks[0])
            if k < 0:  # a control string may go on in the next piece
                self.rest = data[-2:]
                data = data[:-2]
                break
            yield self.place, data[:k]
            data = data[k + 3 :]
            self.place = PLACE[self.marks.pop(0)]
        yield self.place, data

    def close(self) -> Iterator[tuple[int, bytes]]:
        yield self.place, self.rest


def restored_pieces(ordered: DataFrame) -> DataFrame:
    """From pieces in output order, those of the restored texts (part 0 to 2, position), and a row of part 3 for each
    document with its facts and the digest of its output. Works on the output and its form alone."""
    out = f"row bigint, part int, position int, doc_id bigint, {_FACTS}, output_sha256 string, piece binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _Out(_arrow(out))
        row, facts, digest, reader, count = None, (), hashlib.sha256(), _Reader("plain"), 0

        def put(parts: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
            nonlocal count
            for part, piece in parts:
                if piece:
                    yield from kept.add((row, part, count, *(None,) * 6, piece), len(piece))
                    count += 1

        def close() -> Iterator[pa.RecordBatch]:
            if row is not None:
                yield from put(reader.close())
                yield from kept.add((row, 3, count, *facts, digest.hexdigest(), None))

        for batch in batches:
            names = ("row", "doc_id", "n", "form", "prefix_chars", "middle_chars")
            for at, doc, n, form, a, b, piece in zip(*[batch.column(c).to_pylist() for c in names], batch.column("piece")):
                if at != row:
                    yield from close()
                    row, facts, digest, reader, count = at, (doc, n, form, a, b), hashlib.sha256(), _Reader(form), 0
                data = piece.as_py()
                digest.update(data)
                yield from put(reader.read(data))
        yield from close()
        yield from kept.flush()

    return ordered.mapInArrow(run, out)


def fim_digests(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = PIECE) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) for every row; cases as in `fim_pieces`."""
    restored = restored_pieces(in_order(fim_pieces(docs, id, text, size))).sortWithinPartitions("row", "part", "position")
    out = f"doc_id bigint, {_FACTS}, output_sha256 string, restored_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, digest = _Out(_arrow(out)), hashlib.sha256()
        names = ("part", "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256")
        for batch in batches:
            for part, *facts, piece in zip(*[batch.column(c).to_pylist() for c in names], batch.column("piece")):
                if part < 3:
                    digest.update(piece.as_py())
                else:
                    yield from kept.add((*facts, digest.hexdigest()))
                    digest = hashlib.sha256()
        yield from kept.flush()

    return restored.mapInArrow(run, out)


def fill_in_middle(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = PIECE) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): the transformed texts; cases as in `fim_pieces`. A row holds a
    whole output, as `docs` holds a whole text; where that is too much, write `in_order(fim_pieces(docs))`."""
    out = f"doc_id bigint, {_FACTS}, output string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, row, facts, parts = _Out(_arrow(out)), None, (), []
        names = ("row", "doc_id", "n", "form", "prefix_chars", "middle_chars")
        for batch in batches:
            for at, *said, piece in zip(*[batch.column(c).to_pylist() for c in names], batch.column("piece")):
                if at != row:
                    if row is not None:
                        whole = b"".join(parts)
                        yield from kept.add((*facts, whole.decode()), len(whole))
                    row, facts, parts = at, said, []
                parts.append(piece.as_py())
        if row is not None:
            yield from kept.add((*facts, b"".join(parts).decode()))
        yield from kept.flush()

    return in_order(fim_pieces(docs, id, text, size)).mapInArrow(run, out)
