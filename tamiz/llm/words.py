"""Folded words of whole texts, their hashes and runs, in Arrow's and numpy's vectorised kernels.

Built-in expressions fold a character at a time through objects; Arrow's kernels do the same work on whole columns at
about a third of the CPU time, and numpy hashes every run of words of a batch in a few passes. Both operators that need the
words of every document share this module.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text that is worked on at once inside a batch, so that temporary columns stay small however long the texts are.
SLICE_BYTES = 8 << 20
#: A filter that stands for a set of hashes has 16 bits for each, within these bounds; a fuller one only lets more through.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
_BUCKET_BITS = 32_768
_STEP = 0x9E3779B97F4A7C15


@dataclass
class Words:
    """The words of several texts, one after the other."""

    code: object  # hash of each word, uint64
    index: object  # its place in `vocabulary`
    vocabulary: list
    size: object  # words of each text

    @property
    def start(self):
        return self.size.cumsum() - self.size


def slices(batch, column: str) -> Iterator:
    """The batch in parts of about SLICE_BYTES of text, at least one row each."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    part = pc.divide(pc.cumulative_sum(lengths.cast(pa.int64())), SLICE_BYTES).to_numpy(zero_copy_only=False)
    edges = [0, *(i for i in range(1, len(part)) if part[i] != part[i - 1]), len(part)]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def lowered(texts):
    """Lower case without U+0300-036F after decomposition; null becomes empty, bytes that are no UTF-8 become U+FFFD."""
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.fill_null(texts, "")
    try:
        flat = pc.utf8_normalize(pc.utf8_lower(texts), "NFD")
    except pa.ArrowInvalid:
        texts = pa.array([b.decode("utf-8", "replace") for b in texts.cast(pa.binary()).to_pylist()], pa.string())
        flat = pc.utf8_normalize(pc.utf8_lower(texts), "NFD")
    return pc.replace_substring_regex(flat, "[̀-ͯ]+", "")


def split_words(flat, other: str = "[^a-z0-9]+", number: str | None = None) -> Words:
    """Words of lowered texts: what stands between runs of `other`; words of digits only become `number` if that is given."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.split_pattern(pc.replace_substring_regex(flat, other, " "), " ")
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    pieces = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    full = pc.not_equal(pieces, "").to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(full)])
    size = np.diff(before[offsets - offsets[0]])
    coded = pieces.filter(pa.array(full)).dictionary_encode()
    vocabulary = coded.dictionary.to_pylist()
    if number is not None:
        vocabulary = [number if w.isdigit() else w for w in vocabulary]
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    hashes = pd.util.hash_array(np.array(vocabulary, dtype=object), categorize=False) if vocabulary else np.zeros(0, np.uint64)
    return Words(hashes[index], index, vocabulary, size)


def mixed(h, salt: int):
    """Spread sums of word hashes over all 64 bits."""
    import numpy as np

    h = (h + np.uint64(salt)) * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def power(k: int) -> int:
    return pow(_STEP, k, 1 << 64)


def runs(code, k: int):
    """Hash of the `k` words from each place on, for all but the last k - 1 places."""
    import numpy as np

    n = max(0, len(code) - k + 1)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h += code[j : j + n] * np.uint64(power(j))
    return mixed(h, k)


def bit_filter(hashes: DataFrame, column: str):
    """Broadcast numpy bit set for the hashes in `column`: no member is ever missed, some others pass.

    The executors combine 4 KB bitmaps; the driver gets the finished filter, at most MOST_BITS / 8 bytes (32 MB) whatever the set.
    `hashes` is counted first and should be materialised.
    """
    import numpy as np

    size = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * hashes.count()).bit_length()))
    bit = F.pmod(F.col(column), F.lit(size))
    parts = hashes.select(F.floor(bit / _BUCKET_BITS).cast("int").alias("b"), (bit % _BUCKET_BITS).alias("p")).groupBy("b").agg(F.bitmap_construct_agg("p").alias("m"))
    out = np.zeros(size // 8, np.uint8)
    for r in parts.toLocalIterator():
        out[r["b"] * _BUCKET_BITS // 8 : (r["b"] + 1) * _BUCKET_BITS // 8] = np.frombuffer(bytes(r["m"]), np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(out)


def passes(bits, h):
    """Which of the hashes may be members."""
    import numpy as np

    at = h & np.uint64(8 * len(bits) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
