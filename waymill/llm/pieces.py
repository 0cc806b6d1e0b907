"""SentencePiece encoding and decoding through a distinct-chunk table.

No piece of the model holds a whitespace marker after another character, and its normaliser
keeps every character and space (both are checked when the model is loaded), so no merge
crosses from a word into the marker before the next one. A text is therefore cut into marked
chunks, a run of markers and what follows up to the next marker, and its ids are those of its
chunks, gathered by position.

The table: every chunk of the corpus is counted (combined in each task, then by one shuffle
of distinct chunks). The most frequent ones, ``FREQUENT`` at most and none above
``CHUNK_CHARS``, so of a proven size, are segmented once each in a job of their own and sent
to every task, which looks each position up in place. The rest is exact too: a chunk outside
the table is segmented where it occurs, once a block of rows. Joining those back by position
would shuffle every text (README has the measured figures), which the operator's disk
does not allow.

A block is at most ``BLOCK_CHARS`` of text (one longer text is a block of its own), and what
it adds to the table goes with it, so memory is bounded whatever the corpus. Texts are never
shuffled and a lost task is simply run again.

Defined cases: a null text is the empty text, which has the begin and end ids only and
decodes to the empty text; a very long text is a block of its own; extra columns and repeated
rows pass through (``ids`` and ``decoded`` are replaced); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymill.operators.shared import materialize

MARK = "▁"
BLOCK_CHARS = 1 << 21
COUNT_CHUNKS = 1 << 18  # distinct chunks that a task counts before it passes them on
FREQUENT = 1 << 17
CHUNK_CHARS = 64
STEPS = 16  # count classes per doubling
CHUNK = re.compile(" +[^ ]*")
#: Characters and spaces that normalisers like to change.
PROBES = ("a  b", " a", "a ", "\ufb01", "\uff21", "\u00e9", "e\u0301", "\u00bd", "\t\n", "\u00a0", "\u3000", "\u200b", "Stra\u00dfe \u0130", "\u2026", "\uac00")


def chunks(text: str) -> list[str]:
    """Chunks of a non-empty text, each without its first marker; a literal marker counts as a space."""
    text = text.replace(MARK, " ")
    words = text.split(" ")
    return words if "" not in words else [c[1:] for c in CHUNK.findall(" " + text)]


class ChunkTable:
    """Marked chunks (without their first marker) -> ids as little-endian 32-bit, and decoded text."""

    def __init__(self, model_file: str, known: tuple[list[str], list[bytes], list[str]] = ((), (), ())):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self._check()
        names, ids, decoded = known
        self.ids: dict[str, bytes] = dict(zip(names, ids, strict=True))
        self.decoded: dict[str, str] = dict(zip(names, decoded, strict=True))
        self.ends = tuple(i.to_bytes(4, "little") for i in (self.sp.bos_id(), self.sp.eos_id()))

    def _check(self) -> None:
        crossing = [p for p in map(self.sp.id_to_piece, range(self.sp.get_piece_size())) if MARK in p.lstrip(MARK)]
        changed = [p for p in PROBES if self.sp.decode(self.sp.encode(p)) != p]
        if crossing or changed or not self.sp.encode_as_pieces("x")[0].startswith(MARK):
            raise ValueError(f"the model's words are not independent: pieces across markers {crossing[:3]}, changed texts {changed[:3]}")

    def segment(self, names: list[str]) -> tuple[list[bytes], list[str]]:
        """The library itself puts the first marker back, save for the empty chunk, a lone
        marker, which is what it gives a lone space less one."""
        ids = self.sp.encode(names, num_threads=1)
        mark = [self.sp.piece_to_id(MARK)]
        ids = [x if name else mark for name, x in zip(names, ids, strict=True)]
        return [np.array(x, "<u4").tobytes() for x in ids], [" " + t for t in self.sp.decode(ids)] if ids else []

    def block(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str]]:
        """(ids with begin and end, decoded text) for each text."""
        cut = [chunks(t) if t else [] for t in texts]
        new = [c for c in dict.fromkeys(c for words in cut for c in words) if c not in self.ids]
        ids, decoded = self.segment(new)
        self.ids.update(zip(new, ids, strict=True))
        self.decoded.update(zip(new, decoded, strict=True))
        begin, end = self.ends
        for words in cut:
            yield np.frombuffer(begin + b"".join(map(self.ids.__getitem__, words)) + end, "<u4"), "".join(map(self.decoded.__getitem__, words))[1:]
        for c in new:
            del self.ids[c], self.decoded[c]


def chunk_counts(docs: DataFrame) -> DataFrame:
    """chunk, n: how often each distinct chunk of at most ``CHUNK_CHARS`` occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            short = [(c, n) for c, n in seen.items() if len(c) <= CHUNK_CHARS]
            seen.clear()
            return pa.RecordBatch.from_pydict({"chunk": pa.array([c for c, _ in short], pa.string()), "n": pa.array([n for _, n in short], pa.int64())})

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(chunks(text))
                if len(seen) > COUNT_CHUNKS:
                    yield out()
        yield out()

    return docs.select("text").mapInArrow(count, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))


def frequent(docs: DataFrame) -> DataFrame:
    """The chunks of the highest count classes, ``FREQUENT`` at most; classes are never split."""
    counted = materialize(chunk_counts(docs).withColumn("class", F.floor(F.log2("n") * STEPS).cast("int")), "chunks")
    sizes = {r["class"]: r["k"] for r in counted.groupBy("class").agg(F.count(F.lit(1)).alias("k")).collect()}  # STEPS a doubling
    least, held = None, 0
    for at in sorted(sizes, reverse=True):
        held += sizes[at]
        if held > FREQUENT:
            break
        least = at
    return counted.filter(F.col("class") >= least) if least is not None else counted.limit(0)


def chunk_table(docs: DataFrame, name: str) -> tuple[list[str], list[bytes], list[str]]:
    """The frequent chunks with their ids and decoded texts, each segmented once."""

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            table = table or ChunkTable(SparkFiles.get(name))
            names = batch.column(0).to_pylist()
            ids, decoded = table.segment(names)
            yield pa.RecordBatch.from_pydict({"chunk": pa.array(names, pa.string()), "ids": pa.array(ids, pa.binary()), "decoded": pa.array(decoded, pa.string())})

    rows = frequent(docs).select("chunk").mapInArrow(segment, "chunk string, ids binary, decoded string").toArrow()  # FREQUENT rows of CHUNK_CHARS at most
    return tuple(rows.column(c).to_pylist() for c in ("chunk", "ids", "decoded"))


def _blocks(texts: pd.Series) -> Iterator[list[str]]:
    block, chars = [], 0
    for t in texts:
        t = t if isinstance(t, str) else ""
        if block and chars + len(t) > BLOCK_CHARS:
            yield block
            block, chars = [], 0
        block.append(t)
        chars += len(t)
    if block:
        yield block


def ship(docs: DataFrame, model_file: str) -> str:
    """Send the vocabulary file with the job; executors open their own copy."""
    sc, name = docs.sparkSession.sparkContext, model_file.rsplit("/", 1)[-1]
    if not any(f.endswith(f"/{name}") for f in sc.listFiles):
        sc.addFile(model_file)
    return name


def _pieces(docs: DataFrame, model_file: str, row, kind: str):
    """An iterator pandas UDF over the shared table; ``row(ids, decoded)`` gives a result row."""
    name = ship(docs, model_file)
    shared = docs.sparkSession.sparkContext.broadcast(chunk_table(docs, name))

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = ChunkTable(SparkFiles.get(name), shared.value)
        for batch in batches:
            yield pd.DataFrame([row(ids, text) for block in _blocks(batch) for ids, text in table.block(block)], columns=[x.split()[0] for x in kind.split(", ")])

    return run


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """``docs`` with ids array<int> and decoded string (columns of those names are replaced)."""
    run = _pieces(docs, model_file, lambda ids, text: (ids.astype("int32"), text), "ids array<int>, decoded string")
    names = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("ids", "decoded")]
    return docs.select(*names, run(F.col("text")).alias("waymill pieces")).select(*names, "`waymill pieces`.ids", "`waymill pieces`.decoded")


def digests(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian 32-bit), decoded_sha256."""

    def row(ids: np.ndarray, text: str) -> tuple:
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    run = _pieces(docs, model_file, row, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return docs.select("doc_id", run("text").alias("p")).select("doc_id", "p.*")
