"""Corpus encoding with a public byte-level BPE; long texts by tree concatenation.

Texts of ordinary size are encoded in Arrow batches. A longer text is cut into pieces that
are encoded in parallel as rows of their own and then joined pairwise as a tree; around each join growing
windows are re-encoded until both sides agree, which makes the result exact.
"""

from __future__ import annotations

import base64
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Texts above this many characters are cut; also the length of the pieces.
PIECE_CHARS = 1 << 20
#: Runs without a pre-token boundary above this many bytes are halved as well.
RUN_BYTES = 1 << 12


def default_vocabulary() -> str:
    """TAMIZ_TOKENIZER, else byte_bpe_50k of the installed public tokenizers."""
    return os.environ.get("TAMIZ_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")


class TreeEncoder:
    """Exact ids of any text; safe for runs of any length without a boundary."""

    # Fixed value: the public pre-token pattern of this vocabulary.
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    #: Places that end a pre-token whatever stands around: the class changes after a character that is no
    #: white space, save between an apostrophe and a letter (a contraction or not, by what came before).
    BORDER = r"(?<=\p{L})(?=\P{L})|(?<=\p{N})(?=\P{N})|(?<=[^\s\p{L}\p{N}'])(?=[\s\p{L}\p{N}])|(?<=')(?=[\s\p{N}])"

    def __init__(self, vocabulary: str, run_bytes: int = RUN_BYTES):
        import regex
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.enc = tiktoken.Encoding("public", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.words = regex.compile(self.PATTERN)
        self.border, self.last_border = regex.compile(self.BORDER), regex.compile("(?r)" + self.BORDER)
        n = run_bytes
        self.long_run = regex.compile(rf"\p{{L}}{{{n},}}|\p{{N}}{{{n},}}|[^\s\p{{L}}\p{{N}}]{{{n},}}|\s{{{n},}}")
        self.run_bytes = run_bytes

    def run(self, piece: bytes) -> list[int]:
        """Ids of one pre-token, whatever its length."""
        if len(piece) <= self.run_bytes:
            return self.enc._encode_single_piece(piece)
        half = len(piece) // 2
        return self.join(self.run(piece[:half]), self.run(piece[half:]))

    def agree(self, a: int, b: int) -> bool:
        """Whether two neighbouring ids stay as they are when their bytes are encoded together."""
        both = self.enc.decode_single_token_bytes(a) + self.enc.decode_single_token_bytes(b)
        return self.enc._encode_single_piece(both) == [a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of two adjoining parts of one pre-token.

        A sequence of ids is the encoding of its bytes exactly if every neighbouring pair is. Only the pair at the
        join can be wrong; a window around it is re-encoded and grown until its both edges agree with what stands outside.
        """
        if not left or not right or self.agree(left[-1], right[0]):
            return left + right
        k = 1
        while True:
            i, j = max(0, len(left) - k), min(len(right), k)
            window = b"".join(map(self.enc.decode_single_token_bytes, left[i:] + right[:j]))
            mid = self.enc._encode_single_piece(window)
            if (i == 0 or self.agree(left[i - 1], mid[0])) and (j == len(right) or self.agree(mid[-1], right[j])):
                return left[:i] + mid + right[j:]
            k *= 2

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text, [] for null and empty; strings that look like special tokens are ordinary text."""
        if not text:
            return []
        if not self.long_run.search(text):
            return self.enc.encode_ordinary(text)
        out: list[int] = []
        for m in self.words.finditer(text):
            out.extend(self.run(m.group().encode("utf-8")))
        return out

    def split_part(self, part: str) -> tuple[str, list[int], str | None]:
        """A piece cut anywhere out of a text: text up to its first certain border, ids between the first and the
        last, text after it. Without a border: the whole text, its ids if it is one run, and None."""
        first = self.border.search(part)
        if first is None:
            one = self.words.fullmatch(part)
            return part, self.run(part.encode("utf-8")) if one else [], None
        p, q = first.start(), self.last_border.search(part).start()
        return part[:p], self.encode(part[p:q]), part[q:]

    def _gap(self, gap: list[tuple[str, list[int]]]) -> list[int]:
        """Ids of neighbouring texts without a certain border between them; ids of whole runs are used again."""
        text = "".join(x for x, _ in gap)
        out: list[int] = []
        for m in self.words.finditer(text):
            if m.end() - m.start() <= self.run_bytes:
                out.extend(self.run(m.group().encode("utf-8")))
                continue
            parts, at = [], 0
            for x, ids in gap:
                lo, hi = max(at, m.start()), min(at + len(x), m.end())
                if lo < hi:
                    whole = ids and hi - lo == len(x)
                    parts.append(ids if whole else self.run(text[lo:hi].encode("utf-8")))
                at += len(x)
            while len(parts) > 1:
                parts = [self.join(parts[i], parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
            out.extend(parts[0])
        return out

    def join_parts(self, parts: list[tuple[str, list[int], str | None]]) -> list[int]:
        """Ids of a whole text from its split parts in order."""
        out: list[int] = []
        gap: list[tuple[str, list[int]]] = []
        for head, ids, tail in parts:
            if tail is None:
                gap.append((head, ids))
                continue
            gap.append((head, []))
            out.extend(self._gap(gap))
            out.extend(ids)
            gap = [(tail, [])]
        return out + self._gap(gap)


def _encode_batches(vocabulary: str, run_bytes: int):
    def run(batches):
        import pyarrow as pa

        t = TreeEncoder(vocabulary, run_bytes)
        for b in batches:
            ids = pa.array([t.encode(x) for x in b.column("text").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids], ["doc_id", "ids"])

    return run


def encode_corpus(docs: DataFrame, vocabulary: str | None = None, piece_chars: int = PIECE_CHARS, run_bytes: int = RUN_BYTES) -> DataFrame:
    """`doc_id, ids` of `docs(doc_id, text)`: one row per input row, [] for null and empty texts, no special tokens.

    Rows with a null or repeated id keep their own rows. Further columns don't matter; an empty table gives no rows.
    No shuffle for texts up to `piece_chars`; longer ones are spread over the cluster in pieces, each
    and put together by their position.
    """
    vocabulary = vocabulary or default_vocabulary()
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    n = F.length("text")
    short = rows.where(n.isNull() | (n <= piece_chars)).mapInArrow(_encode_batches(vocabulary, run_bytes), "doc_id bigint, ids array<int>")
    # Each long row gets its own number, so equal ids don't mix.
    pieces = rows.where(n > piece_chars).select(
        "doc_id", F.struct(F.monotonically_increasing_id().alias("row"), n.alias("n"), F.xxhash64("text").alias("h")).alias("key"), "text"
    )
    starts = F.sequence(F.lit(0), ((F.length("text") - 1) / piece_chars).cast("int"))
    pieces = pieces.select("doc_id", "key", F.explode(starts).alias("k"), "text").select(
        "doc_id", "key", "k", F.substring("text", F.col("k") * piece_chars + 1, F.lit(piece_chars)).alias("part")
    )

    def encode_parts(batches):
        import pyarrow as pa

        t = TreeEncoder(vocabulary, run_bytes)
        for b in batches:
            heads, ids, tails = zip(*map(t.split_part, b.column("part").to_pylist())) if b.num_rows else ((), (), ())
            made = [pa.array(heads, pa.string()), pa.array(ids, pa.list_(pa.int32())), pa.array(tails, pa.string())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), b.column("k"), *made], ["doc_id", "key", "k", "head", "ids", "tail"])

    key_type = pieces.schema["key"].dataType.simpleString()
    done = pieces.repartition("key", "k").mapInArrow(encode_parts, f"doc_id bigint, key {key_type}, k int, head string, ids array<int>, tail string")
    whole = done.groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct("k", "head", "ids", "tail"))).alias("parts"))

    def join_parts(batches):
        import pyarrow as pa

        t = TreeEncoder(vocabulary, run_bytes)
        for b in batches:
            out = [t.join_parts([(p["head"], p["ids"], p["tail"]) for p in parts]) for parts in b.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return short.unionByName(whole.mapInArrow(join_parts, "doc_id bigint, ids array<int>"))


def ids(spark, sf_dir: str) -> DataFrame:
    """Problem 8: every document as ids of byte_bpe_50k."""
    return encode_corpus(spark.read.parquet(f"{sf_dir}/documents.parquet"))
