"""Alignment of two tokenizers, with pair counts from external spill runs.

Tokens of A and B are compared by the bytes that they stand for. Offsets where tokens of both end
cut a text into groups; every A-B pair of occurrences whose byte ranges overlap is a link. A text
falls into chunks where both tokenizers must cut: at a single space between two characters that
are no white space. So a chunk's groups and links depend on the chunk alone; each distinct chunk
of a block of texts is encoded once, and the frequent ones once a task (``MEMO``).

An id pair's count is the number of documents that hold it linked. Counting is external:

1. Each task turns its texts, in blocks, into pair-document records (A id, B id, document, links)
   and partitions them by A id into radixes. A block's records of one radix, sorted by pair and
   document, are a run: the pairs with their numbers of documents, and the postings, each a
   zstandard frame. Runs are written to the shared folder.
2. The task of a radix merges its runs by a heap, in order of A and then B id. Equal pairs follow
   one another, so a pair's count is complete when the next begins, and an A id's maximum when the
   next A id does; what is held is a place in each run and the counts of the pairs of the radix.
3. With those the postings are streamed again, a run at a time: each document of the run gets the
   sum of its links' counts and its links at the maximum. They go back to their block, packed in
   one array a block and task, and are added up there.

A run holds a pair once, however many documents of the block have it, so a pair of every document
costs a task an entry a block; its documents cost about a bit each. Radixes of one task are dealt
round, so the frequent ids, which have the low numbers, are spread.

Defined cases: null and empty texts, and texts whose joined tokens differ from space + text in A
or B (a literal U+2581, say), have no tokens: zeros and an empty digest; special tokens inside a
text are plain text; a very long text is a block of its own; a null doc_id is kept; rows repeated
count as documents each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
import zstandard
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymill.llm.pieces import ship
from waymill.operators.shared import materialize

MARK = "▁"
BLOCK_CHARS, BLOCK_DOCS = 1 << 22, 1 << 14
MEMO = 1 << 17  # chunks that a task remembers, none above ``MEMO_CHARS``
MEMO_CHARS = 64
RADIXES = 4  # a task
HELD_DOCS = 1 << 20  # documents whose sums a task holds before it passes them on
LEVEL = 3
CUT = re.compile(r"(?<=\S) (?=\S)")  # \S here is narrower than in A's own pattern: each cut is one of A's


def _byte_level() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte: printable ones stand for themselves, the rest follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligned(NamedTuple):
    """Chunks in columns: numbers of tokens (-1 where the bytes differ), groups and links, the links' keys one chunk after another, the groups as text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    keys: np.ndarray
    groups: list[str]

    def __add__(self, other: Aligned) -> Aligned:
        return Aligned(*[np.concatenate([x, y]) for x, y in zip(self[:5], other[:5], strict=True)], self.groups + other.groups)

    def first(self, n: int) -> Aligned:
        return Aligned(*[x[:n] for x in self[:4]], self.keys[: int(self.n_links[:n].sum())], self.groups[:n])


class Documents(NamedTuple):
    """Texts in columns; ``keys`` and ``owners`` have an entry a link."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    keys: np.ndarray
    owners: np.ndarray


def _none() -> Aligned:
    return Aligned(*[np.zeros(0, np.int64)] * 5, [])


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(counts.sum())), counts


class Aligner:
    """Groups and links of chunks, all chunks of a call at once."""

    def __init__(self, a_file: str, b_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = tokenizers.Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        letters = _byte_level()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(map(letters.__getitem__, x)) if set(x) <= set(letters) else b"" for x in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        crossing = [p for p in pieces if MARK in p.lstrip(MARK)]
        if crossing:
            raise ValueError(f"pieces cross markers: {crossing[:3]}")
        self.a_len = np.fromiter(map(len, self.a_bytes), np.int64)
        self.b_len = np.fromiter(map(len, self.b_bytes), np.int64)
        decimal = list(map(str, range(max(len(names), len(pieces)))))
        self.decimal = np.array([x + mark for mark in (",", "|", ";", "") for x in decimal], object).reshape(4, -1)
        self.index: dict[str, int] = {}
        self.known = _none()

    def align(self, chunks: list[str]) -> Aligned:
        if not chunks:
            return _none()
        a_ids = [e.ids for e in self.a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)]
        b_ids = self.b.encode(chunks, num_threads=1)
        whole = [b" " + c.encode("utf-8", "surrogatepass") for c in chunks]
        same = [b"".join(map(self.a_bytes.__getitem__, a)) == b"".join(map(self.b_bytes.__getitem__, b)) == w for a, b, w in zip(a_ids, b_ids, whole, strict=True)]
        good = np.array(same)
        (a, n_a), (b, n_b) = _flat([x for x, ok in zip(a_ids, same, strict=True) if ok]), _flat([x for x, ok in zip(b_ids, same, strict=True) if ok])
        # The chunks stand one after another: both tokenizers cut the same bytes, and both cut between chunks.
        chunk_ends = np.cumsum(np.fromiter(map(len, itertools.compress(whole, same)), np.int64))
        a_ends, b_ends = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        ends, shared = np.union1d(a_ends, b_ends), np.intersect1d(a_ends, b_ends, assume_unique=True)
        keys = a[np.searchsorted(a_ends, ends)] << 32 | b[np.searchsorted(b_ends, ends)]  # a stretch between two ends is the overlap of one pair
        upto = lambda x: np.diff(np.searchsorted(x, chunk_ends, "right"), prepend=0)
        # Text: A's ids of a group, then B's; what follows an id says what comes next.
        place = np.concatenate([2 * np.searchsorted(shared, a_ends), 2 * np.searchsorted(shared, b_ends) + 1])
        order = np.argsort(place, kind="stable")
        place = place[order]
        step = np.diff(place, append=-1)
        mark = np.where(step == 0, 0, np.where(place % 2 == 0, 1, 2))
        last = np.cumsum(n_a + n_b)
        mark[last - 1] = 3
        words = self.decimal[mark, np.concatenate([a, b])[order]].tolist()
        groups = iter(["".join(words[i:j]) for i, j in zip([0, *last[:-1].tolist()], last.tolist(), strict=True)] if len(last) else [])

        def spread(values: np.ndarray, missing: int) -> np.ndarray:
            out = np.full(len(chunks), missing, np.int64)
            out[good] = values
            return out

        return Aligned(spread(n_a, -1), spread(n_b, -1), spread(upto(shared), 0), spread(upto(ends), 0), keys, [next(groups) if ok else "" for ok in same])

    def block(self, texts: list[str | None]) -> Documents:
        cut = [CUT.split(t) if t else [] for t in texts]
        new = [c for c in dict.fromkeys(itertools.chain.from_iterable(cut)) if c not in self.index]
        new.sort(key=lambda c: len(c) > MEMO_CHARS)  # what a task may remember comes first
        number = self.index | {c: i for i, c in enumerate(new, len(self.index))} if new else self.index
        table = self.known + self.align(new)
        at, counts = _flat([[number[c] for c in words] for words in cut])
        owner = np.repeat(np.arange(len(texts)), counts)
        bad = np.zeros(len(texts), bool)
        bad[owner[table.n_a[at] < 0]] = True
        bad[counts == 0] = True
        at, owner = at[~bad[owner]], owner[~bad[owner]]
        n_a, n_b, n_groups, n_links = (np.bincount(owner, x[at], minlength=len(texts)).astype(np.int64) for x in table[:4])
        begin, many = np.cumsum(table.n_links) - table.n_links, table.n_links[at]
        within = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        digests = ["" if no else hashlib.sha256(";".join([table.groups[number[c]] for c in words]).encode()).hexdigest() for no, words in zip(bad.tolist(), cut, strict=True)]
        keep = min(len(new), max(0, MEMO - len(self.index)), sum(len(c) <= MEMO_CHARS for c in new))
        if keep:
            self.known = table.first(len(self.index) + keep)
            self.index |= {c: number[c] for c in new[:keep]}
        return Documents(n_a, n_b, n_groups, n_links, digests, table.keys[np.repeat(begin[at], many) + within], np.repeat(owner, many))


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=LEVEL).compress(np.ascontiguousarray(values).tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values[:1] * 0)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    texts = batch.column("text")
    for i in range(batch.num_rows):
        size += len(texts[i].as_py() or "")
        if size > BLOCK_CHARS or i + 1 - begin == BLOCK_DOCS or i + 1 == batch.num_rows:
            yield begin, i + 1
            begin, size = i + 1, 0


def runs_of(keys: np.ndarray, owners: np.ndarray, radixes: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(radix, packed pairs, packed postings) of a block's links: key of the pair and number of the document."""
    a, b = keys >> 32, keys & 0xFFFFFFFF
    ids = int(a.max(initial=0)) // radixes + 1
    # One number a link, by radix, A id, B id and document: below 2^63 for vocabularies of 2^24 ids.
    coded = np.sort(((a % radixes * ids + a // radixes) << 24 | b) << 14 | owners)
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(coded)), bool), coded[1:] != coded[:-1]]))
    links = np.diff(first, append=len(coded))
    coded = coded[first]
    owners, b, a = coded & (BLOCK_DOCS - 1), coded >> 14 & 0xFFFFFF, coded >> 38
    radix = a // ids
    keys = (a % ids * radixes + radix) << 32 | b
    cuts = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), radix[1:] != radix[:-1]]))
    for begin, end in zip(cuts, np.append(cuts[1:], len(keys))[: len(cuts)], strict=True):
        k, o, n = keys[begin:end], owners[begin:end], links[begin:end]
        new = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        pairs = np.concatenate([_steps(k[new] >> 32), k[new] & 0xFFFFFFFF, np.diff(new, append=len(k))]).astype("<u4")
        step = _steps(o)
        step[new] = o[new]
        yield int(radix[begin]), _pack(pairs), _pack(np.concatenate([step.astype("<u2").view("u1"), n.astype("<u4").view("u1")]))


def pairs_of(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Keys, ascending, and numbers of documents."""
    a, b, n = _unpack(run, "<u4").astype(np.int64).reshape(3, -1)
    return np.cumsum(a) << 32 | b, n


def postings_of(run: bytes, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents and links, pair after pair."""
    data = _unpack(run, "u1")
    many = int(n.sum())
    step, links = data[: 2 * many].view("<u2").astype(np.int64), data[2 * many :].view("<u4").astype(np.int64)
    total, first = np.cumsum(step), np.cumsum(n) - n
    return total - np.repeat(total[first] - step[first], n), links


def spill(docs: DataFrame, a_name: str, b_name: str, radixes: int) -> DataFrame:
    """Written out: a row a block with its documents (radix null), and a row a run.

    A block is named by its task and number, so that a task run again names it alike.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(SparkFiles.get(a_name), SparkFiles.get(b_name))
        for batch in batches:
            for begin, end in _blocks(batch):
                part = batch.slice(begin, end - begin)
                found = aligner.block(part.column("text").to_pylist())
                block = part.column("row")[0].as_py()
                runs = list(runs_of(found.keys, found.owners, radixes))
                own = [pa.ListArray.from_arrays(pa.array([0, end - begin], pa.int32()), pa.array(x)) for x in found[:4]]
                own.append(pa.array([found.digests], pa.list_(pa.string())))
                ids = pa.ListArray.from_arrays(pa.array([0, end - begin], pa.int32()), part.column("doc_id"))
                more = len(runs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block] * (more + 1), pa.int64()), pa.array([None, *[r for r, _, _ in runs]], pa.int32()),
                        *[pa.concat_arrays([x, pa.nulls(more, x.type)]) for x in (ids, *own)],
                        pa.array([None, *[p for _, p, _ in runs]], pa.binary()), pa.array([None, *[p for _, _, p in runs]], pa.binary()),
                    ],
                    ["block", "radix", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "postings"],
                )

    schema = f"block long, radix int, doc_id array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, pairs binary, postings binary"
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return materialize(rows.mapInArrow(send, schema), "runs")


def merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all runs, ascending, their counts, and which have the highest count of their A id."""
    streams = [zip(keys.tolist(), n.tolist(), strict=True) for keys, n in runs]
    keys, counts, best = [], [], []
    last, top, since = -1, 0, 0  # key, highest count of its A id, first pair of that id
    for key, n in heapq.merge(*streams):
        if key == last:
            counts[-1] += n
            continue
        if counts and counts[-1] > top:
            top = counts[-1]
        if key >> 32 != last >> 32:
            best += [c == top for c in counts[since:]]
            top, since = 0, len(counts)
        keys.append(key)
        counts.append(n)
        last = key
    if counts:
        top = max(top, counts[-1])
        best += [c == top for c in counts[since:]]
    return np.array(keys, np.int64), np.array(counts, np.int64), np.array(best, bool)


def contributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From runs (block, radix, pairs, postings), sorted by radix: sums of counts and links at the maximum, by block and document."""
    held: dict[int, np.ndarray] = {}
    docs = 0

    def out() -> pa.RecordBatch:
        packed = []
        for sums in held.values():
            some = np.flatnonzero(sums[0])
            packed.append(_pack(np.concatenate([_steps(some), sums[0][some], sums[1][some]]).astype("<i8").view("u1").reshape(-1, 8).T))
        blocks = list(held)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(packed, pa.binary())], ["block", "sums"])

    def radix(runs: list[tuple[int, bytes, bytes]]) -> None:
        nonlocal docs
        pairs = [pairs_of(p) for _, p, _ in runs]
        keys, counts, best = merged(pairs)
        for (block, _, postings), (own, n) in zip(runs, pairs, strict=True):
            at = np.searchsorted(keys, own)
            owners, links = postings_of(postings, n)
            size = int(owners.max()) + 1
            sums = held.get(block)
            if sums is None or sums.shape[1] < size:
                wider = np.zeros((2, size), np.int64)
                if sums is not None:
                    wider[:, : sums.shape[1]] = sums
                docs += size - (0 if sums is None else sums.shape[1])
                held[block] = sums = wider
            sums[0, :size] += np.bincount(owners, links * np.repeat(counts[at], n)).astype(np.int64)  # exact below 2^53
            sums[1, :size] += np.bincount(owners, links * np.repeat(best[at], n)).astype(np.int64)

    now, runs = None, []
    for batch in batches:
        for block, own, pairs, postings in zip(*(batch.column(c).to_pylist() for c in ("block", "radix", "pairs", "postings")), strict=True):
            if own != now and runs:
                radix(runs)
                runs = []
                if docs >= HELD_DOCS:
                    yield out()
                    docs = 0
            now = own
            runs.append((block, pairs, postings))
    if runs:
        radix(runs)
    yield out()


def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the sums of their documents; rows of a block follow one another, its documents first."""
    now, head, sums = None, None, None

    def out() -> pa.RecordBatch:
        columns = [head.column(c)[0].values for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        return pa.RecordBatch.from_arrays([*columns, pa.array(sums[1]), pa.array(sums[0]), head.column("groups_sha256")[0].values], RESULT)

    for batch in batches:
        for i, (block, packed) in enumerate(zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist(), strict=True)):
            if block != now:
                if head is not None:
                    yield out()
                now, head = block, batch.slice(i, 1)
                sums = np.zeros((2, len(head.column("doc_id")[0])), np.int64)
            else:
                data = _unpack(packed, "u1").reshape(8, -1).T.copy().view("<i8").reshape(3, -1)
                at = np.cumsum(data[0])
                sums[0][at] += data[1]
                sums[1][at] += data[2]
    if head is not None:
        yield out()


RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def align(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    spilled = spill(docs, ship(docs, a_file), ship(docs, b_file), parts * RADIXES)
    runs = spilled.filter("radix is not null").select("block", "radix", "pairs", "postings")
    sums = runs.repartitionById(parts, "radix").sortWithinPartitions("radix", "block").mapInArrow(contributions, "block long, sums binary")
    heads = spilled.filter("radix is null").select("block", *[c for c in RESULT if c not in ("n_best", "count_sum")], F.lit(None).cast("binary").alias("sums"))
    both = heads.unionByName(sums, allowMissingColumns=True)
    together = both.repartition(parts, "block").sortWithinPartitions("block", F.col("sums").isNotNull())
    return together.mapInArrow(added, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in RESULT[1:-1]) + ", groups_sha256 string")
