"""Token counts from flat token files: vectorised search for end-of-document ids, stitched across blocks.

A token file is nothing but ids of 2 or 4 bytes, little-endian; an end-of-document id closes each document. There is
no index. Files are cut into blocks; a task reads a block's range and finds its separators in one numpy comparison.
A prefix scan over the blocks' first separators gives documents that run over block ends their extent, so neither a very
long document nor a very large file is held by one task.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import bounded_batches, carried
from millrace.plans.scratch import materialize, scratch_path

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: How the public byte-level vocabularies split texts; fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK_BYTES = 8 << 20
#: Files written here use id 0 as separator, so vocabulary ids are shifted by one.
SEPARATOR = 0
#: Ids before each document's tokens that carry its number: a mark (1: there is one, 2: null), then 5 digits of 13 bits.
HEADER = 6
_DIGITS = np.arange(52, -1, -13)


def _header(id: int | None) -> list[int]:
    return [2, 1, 1, 1, 1, 1] if id is None else [1, *(((id & (1 << 64) - 1) >> int(s) & 8191) + 1 for s in _DIGITS)]


def _read_header(ids: np.ndarray) -> int | None:
    if ids[0] != 1:
        return None
    value = sum(int(d - 1) << int(s) for d, s in zip(ids[1:], _DIGITS)) & (1 << 64) - 1
    return value - (1 << 64) if value >> 63 else value


def write_tokens(docs: DataFrame, id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> str:
    """Tokenize whole texts into flat files of 2-byte ids in the shared folder; returns the folder.

    A null or empty text has a header and a separator only. Spark's text writer writes the bytes with the separator
    as the end of line, so tasks that run again leave no halves.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    if max(ranks.values()) + 2 > 1 << 16:
        raise ValueError("the vocabulary has more ids than two bytes hold")
    shared = spark.sparkContext.broadcast(ranks)  # some MB, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
        for batch in batches:
            out = []
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array(encoder.encode_ordinary(t or ""), np.int64) + 1
                out.append(np.concatenate([np.array(_header(i), np.int64), ids]).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["line"])

    folder = scratch_path(spark, "tokens")
    carried(docs, id, text).mapInArrow(run, "line binary").select(F.col("line").cast("string").alias("value")).write.option("lineSep", "\0\0").text(folder)
    return folder


_SCANNED = "path string, block long, final long, ends array<long>, ids array<long>"


def _scan(width: int, separator: int, header: int, block: int):
    """Separators of each block, and the numbers of the documents that begin after them. A file's start counts as one."""
    kind = np.dtype(f"<u{width}")
    size = block // width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, length, k in zip(*(batch.column(n).to_pylist() for n in ("path", "length", "block"))):
                system, name = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
                total, begin = length // width, k * size
                with system.open_input_file(name) as source:
                    ids = np.frombuffer(source.read_at(min(size + header + 1, total - begin) * width, begin * width), kind)
                    last = np.frombuffer(source.read_at(width, (total - 1) * width), kind)[0]
                ends = np.flatnonzero(ids[:size] == separator)
                if k == 0:
                    ends = np.r_[-1, ends]
                ends = ends[ends + begin + 1 < total]  # nothing follows the last separator
                found = [_read_header(ids[e + 1 : e + 1 + header]) if header else None for e in ends.tolist()]
                rows.append((path, k, total - int(last == separator), (ends + begin).tolist(), found))
            cols = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["path", "block", "final", "ends", "ids"])

    return run


def scan_tokens(spark: SparkSession, folder: str, width: int = 2, separator: int = SEPARATOR, header: int = 0, block: int = BLOCK_BYTES) -> DataFrame:
    """(path, ordinal, begin, n_tokens, doc_id) of every document in the token files of a folder.

    n_tokens leaves out separator and header. A file may lack its last separator; what follows the last one is
    a document if it has tokens. Two separators in a row hold an empty document. Empty files and folders give
    none. doc_id is null where files have no header. Bytes that make no whole id at a file's end are no token.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "[!_.]*").load(folder).select("path", "length")
    blocks = files.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / block)))).where(f"length >= {width}")
    scanned = materialize(blocks.repartition("path", "block").mapInArrow(_scan(width, separator, header, block), _SCANNED), "token-scan")
    after = Window.partitionBy("path").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = scanned.select("path", "block", F.size("ends").cast("long").alias("n"), F.get("ends", F.lit(0)).alias("first"))
    stitched = ends.select("path", "block", F.first("first", ignorenulls=True).over(after).alias("following"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    rows = scanned.join(stitched, ["path", "block"])
    each = rows.select("path", "earlier", "following", "final", "ends", "ids", F.posexplode("ends").alias("k", "end"))
    close = F.coalesce(F.get("ends", F.col("k") + 1), "following", "final")
    return each.select("path", (F.col("earlier") + F.col("k")).alias("ordinal"), (F.col("end") + 1).alias("begin"), (close - F.col("end") - 1 - header).alias("n_tokens"), F.get("ids", F.col("k")).alias("doc_id"))


def token_counts(docs: DataFrame, id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens) for every document, counted in the flat files that `write_tokens` makes of them.

    Null and empty texts have none. Repeated rows give a row each. An empty table gives no rows.
    """
    return scan_tokens(docs.sparkSession, write_tokens(docs, id, text, vocabulary), header=HEADER).select("doc_id", "n_tokens")
