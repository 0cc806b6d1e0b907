"""Per-batch SimHash arithmetic: the small helper that runs inside Arrow tasks."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE_WORDS = 4
HASH_SEED = 42
_SLICE = 1 << 16


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of one whole text: A-Z lower-cased, 4-word shingles with repeats.

    bytes.lower() touches A-Z only and bytes.split() splits on 0x20 and 0x09-0x0D
    only, which is exactly the word rule. Fewer words than a shingle: the whole
    sequence is the one shingle; no word: fingerprint 0. A null text has no word.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE_WORDS:
        return xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: 1 - SHINGLE_WORDS].tolist()
    stops = ends[SHINGLE_WORDS - 1 :].tolist()
    total = len(starts)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, _SLICE):
        hashes = np.array([digest(joined[a:z], HASH_SEED) for a, z in zip(starts[at : at + _SLICE], stops[at : at + _SLICE], strict=True)], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")
