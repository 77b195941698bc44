"""Alignment of two tokenizers over the same bytes, and how often their tokens meet in a corpus.

A text with a space in front is encoded by a byte-level BPE (A) and by a sentence-piece model (B),
which adds that space itself. Byte offsets where a token of A and one of B both end cut the tokens
into groups; the tokens of a group are linked, each of A's with each of B's.

Groups are found by skipping along diagonals: from a common offset on, the two arrays of token ends
are compared at the present shift of their indices in windows that double while they agree and
halve after the first that doesn't, which jumps over a stretch of one-to-one groups in a few
comparisons of memory. The group behind it is irregular: the array that lags is advanced until both
ends agree, and the shift is theirs from there on.

Texts are encoded once, in the tasks that read them, and become numbers and a list of their
different pairs of token ids with the number of links of each; the lists are written once. The
number of documents that hold a pair is summed in Spark, over all of them. Pairs that make up at least one in
``capacity`` of all, hence no more than ``capacity``, are broadcast to the lists, the others are
joined to them; each of the others is in few documents, so no key is hot.

A's ids are those of its merges: a file whose merges aren't in the order of their ids is refused, and
one whose are is applied by rank, which is the same. Both models are read by the driver and sent
to the executors as they are, a few MB.

Defined cases: a text that is null or empty, or that tokens don't give back byte by byte, has no tokens:
zeros, and an empty ``groups``; special tokens in a text are plain text; texts are encoded whole, so a task
needs memory in proportion to its longest text; every row is a document of its own, equal or not; an empty
table gives an empty result; other columns pass through, and a clash with the names of the
results is an error.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from evenkeel.session import materialize

# How byte-level BPE cuts a text into words, and the bytes that it writes as themselves.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_BYTES = (range(33, 127), range(161, 173), range(174, 256))

RUN_BYTES = 1 << 20
CAPACITY = 1 << 18
FEW = 1 << 12
RESULTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the entries of a byte-level BPE."""
    plain = [b for part in PLAIN_BYTES for b in part]
    letters = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    return letters | {chr(256 + k): b for k, b in enumerate(rest)}


class BytePairs:
    """Tokenizer A."""

    def __init__(self, model: bytes) -> None:
        spec = json.loads(model)
        vocabulary = spec["model"]["vocab"]
        special = {t["content"] for t in spec["added_tokens"]}
        letters = byte_letters()
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            if entry not in special:
                self.pieces[i] = bytes(letters[c] for c in entry)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ids = [vocabulary[left + right] for left, right in merges]
        if ids != sorted(set(ids)):
            raise ValueError("the merges aren't in the order of their ids")
        ranks = {piece: i for i, piece in enumerate(self.pieces) if piece}
        self.encoding = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encoding.encode_to_numpy(" " + text).astype(np.int64) for text in texts]


class SentencePieces:
    """Tokenizer B."""

    def __init__(self, model: bytes) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = [self.piece(i) for i in range(self.model.get_piece_size())]

    def piece(self, i: int) -> bytes:
        entry = self.model.id_to_piece(i)
        return bytes([int(entry[3:5], 16)]) if self.model.is_byte(i) else entry.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


def irregular_groups(ends_a: np.ndarray, ends_b: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(a0, a1, b0, b1) of each group but the one-to-one ones; the last ends agree."""
    a, b = ends_a.astype(np.uint32), ends_b.astype(np.uint32)
    a_bytes, b_bytes = a.tobytes(), b.tobytes()
    a_at, b_at = memoryview(a), memoryview(b)
    i, j, n, found = 0, 0, len(a), []
    while i < n:
        # i and j run in bytes within the probes, four to an end.
        x, y, width, room = 4 * i, 4 * j, 4, 4 * n
        while x < room and a_bytes[x : x + width] == b_bytes[y : y + width]:
            x, y, width = x + width, y + width, 2 * width
        if x >= room:
            break
        while width > 4:
            width //= 2
            if a_bytes[x : x + width] == b_bytes[y : y + width]:
                x, y = x + width, y + width
        i, j = x // 4, y // 4
        first_a, first_b, end_a, end_b = i, j, a_at[i], b_at[j]
        while end_a != end_b:
            if end_a < end_b:
                i += 1
                end_a = a_at[i]
            else:
                j += 1
                end_b = b_at[j]
        i, j = i + 1, j + 1
        found.append((first_a, i, first_b, j))
    return found


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each start as many as its length."""
    before = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) + np.repeat(starts - before, lengths)


@dataclass
class Aligned:
    """Tokens of several texts side by side with the bounds of their groups."""

    a: np.ndarray
    b: np.ndarray
    a_bounds: np.ndarray
    b_bounds: np.ndarray
    irregular: np.ndarray

    def __post_init__(self) -> None:
        a0, a1, b0, b1 = self.irregular.T
        self.closes_a, self.closes_b = np.ones(self.a.size, bool), np.ones(self.b.size, bool)
        self.closes_a[spread(a0, a1 - a0 - 1)] = False
        self.closes_b[spread(b0, b1 - b0 - 1)] = False

    def per_text(self, flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(flags))[bounds])

    def groups(self) -> np.ndarray:
        return self.per_text(self.closes_a, self.a_bounds)

    def text_of(self, token: np.ndarray) -> np.ndarray:
        """Which text a token of A is in."""
        return np.searchsorted(self.a_bounds, token, side="right") - 1

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, a * width + b and number of links of each different pair, in that order."""
        a0, a1, b0, b1 = self.irregular.T
        single_a, single_b = np.ones(self.a.size, bool), np.ones(self.b.size, bool)
        single_a[spread(a0, a1 - a0)] = False
        single_b[spread(b0, b1 - b0)] = False
        texts = [self.text_of(np.flatnonzero(single_a))]
        codes = [self.a[single_a] * width + self.b[single_b]]
        links = [np.ones(codes[0].size, np.int64)]
        of = self.text_of(a0)
        shapes, shape_of = np.unique(np.stack([a1 - a0, b1 - b0]), axis=1, return_inverse=True)
        for k, (wide, high) in enumerate(shapes.T):
            members = np.flatnonzero(shape_of.ravel() == k)
            if wide * high <= FEW:
                left = self.a[a0[members][:, None] + np.arange(wide)]
                right = self.b[b0[members][:, None] + np.arange(high)]
                codes.append((left[:, :, None] * width + right[:, None, :]).ravel())
                texts.append(np.repeat(of[members], wide * high))
                links.append(np.ones(codes[-1].size, np.int64))
                continue
            for m in members:
                left, many_left = np.unique(self.a[a0[m] : a1[m]], return_counts=True)
                right, many_right = np.unique(self.b[b0[m] : b1[m]], return_counts=True)
                codes.append((left[:, None] * width + right).ravel())
                texts.append(np.full(codes[-1].size, of[m]))
                links.append(np.outer(many_left, many_right).ravel())
        texts, codes, links = np.concatenate(texts), np.concatenate(codes), np.concatenate(links)
        order = np.lexsort((codes, texts))
        texts, codes, links = texts[order], codes[order], links[order]
        if not codes.size:
            return texts, codes, links
        heads = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]) | (texts[1:] != texts[:-1])))
        return texts[heads], codes[heads], np.add.reduceat(links, heads)

    def written(self) -> list[bytes]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
        ends_a, ends_b = np.flatnonzero(self.closes_a) + 1, np.flatnonzero(self.closes_b) + 1
        group_a = np.cumsum(self.closes_a) - self.closes_a
        group_b = np.cumsum(self.closes_b) - self.closes_b
        place_a = np.arange(self.a.size) + np.append(0, ends_b)[group_a]
        place_b = np.arange(self.b.size) + ends_a[group_b]
        ids = np.empty(self.a.size + self.b.size, np.int64)
        marks = np.empty(ids.size, np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        marks[place_a] = np.where(self.closes_a, ord("|"), ord(","))
        marks[place_b] = np.where(self.closes_b, ord(";"), ord(","))
        digits, lengths = decimals(1 << int(ids.max()).bit_length() if ids.size else 1)
        lengths = lengths[ids]
        letters = np.zeros((ids.size, digits.shape[1] + 1), np.uint8)
        letters[:, :-1] = digits[ids]
        letters[np.arange(ids.size), lengths] = marks
        flat = letters[np.arange(letters.shape[1]) <= lengths[:, None]].tobytes()
        at = np.append(0, np.cumsum(lengths + 1))[self.a_bounds + self.b_bounds]
        return [flat[start : max(start, end - 1)] for start, end in zip(at[:-1], at[1:])]


@lru_cache(maxsize=4)
def decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The digits of 0 to n - 1 from the left, and how many each has."""
    numbers = np.char.encode(np.arange(n).astype(str), "ascii")
    return numbers.view(np.uint8).reshape(n, -1), np.char.str_len(numbers)


def given_back(ids: np.ndarray, pieces: list[bytes], raw: bytes) -> bool:
    return b"".join(map(pieces.__getitem__, ids.tolist())) == raw


def align_texts(texts: list[str], a_model: BytePairs, b_model: SentencePieces) -> Aligned:
    """Texts with no tokens are empty stretches of the result."""
    asked = [k for k, text in enumerate(texts) if text]
    some = [texts[k] for k in asked]
    none = np.zeros(0, np.int64)
    a_ids, b_ids, irregular = [none] * len(texts), [none] * len(texts), []
    for k, text, a, b in zip(asked, some, a_model.encode(some), b_model.encode(some)):
        raw = b" " + text.encode()
        if given_back(a, a_model.pieces, raw) and given_back(b, b_model.pieces, raw):
            a_ids[k], b_ids[k] = a, b
    a_bounds = np.append(0, np.cumsum([x.size for x in a_ids]))
    b_bounds = np.append(0, np.cumsum([x.size for x in b_ids]))
    a, b = np.concatenate(a_ids), np.concatenate(b_ids)
    ends_a, ends_b = piece_lengths(a_model)[a], piece_lengths(b_model)[b]
    # One text ends where both tokenizers end, so the texts of a run are aligned in one go.
    groups = irregular_groups(np.cumsum(ends_a), np.cumsum(ends_b))
    return Aligned(a, b, a_bounds, b_bounds, np.array(groups, np.int64).reshape(-1, 4))


@lru_cache(maxsize=8)
def piece_lengths(model: BytePairs | SentencePieces) -> np.ndarray:
    return np.array([len(piece) for piece in model.pieces], np.int64)


@lru_cache(maxsize=4)
def loaded(kind: type, model: bytes) -> BytePairs | SentencePieces:
    return kind(model)


def text_runs(column: pa.Array, max_bytes: int = RUN_BYTES) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of runs of rows that hold about ``max_bytes`` together."""
    first, run, held = 0, [], 0
    for row, text in enumerate(column):
        value = text.as_py() or ""
        if run and held + len(value) > max_bytes:
            yield first, run
            first, run, held = row, [], 0
        run.append(value)
        held += len(value)
    if run:
        yield first, run


def aligned_batches(
    batches: Iterable[pa.RecordBatch], others: list[str], a_model: BytePairs, b_model: SentencePieces
) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    row = (context.partitionId() if context else 0) << 40
    width = len(b_model.pieces)
    for batch in batches:
        for first, texts in text_runs(batch.column("text")):
            found = align_texts(texts, a_model, b_model)
            of, codes, links = found.pairs(width)
            per_text = np.bincount(of, minlength=len(texts))
            offsets = pa.array(np.append(0, np.cumsum(per_text)).astype(np.int32))
            groups = found.groups()
            hashes = [hashlib.sha256(x).hexdigest() if n else "" for x, n in zip(found.written(), groups)]
            columns = [
                pa.array(row + np.arange(len(texts))),
                pa.array(np.diff(found.a_bounds)),
                pa.array(np.diff(found.b_bounds)),
                pa.array(groups),
                pa.array(np.bincount(of, links, len(texts)).astype(np.int64)),
                pa.array(hashes, pa.string()),
                pa.ListArray.from_arrays(offsets, pa.array(codes)),
                pa.ListArray.from_arrays(offsets, pa.array(links)),
            ]
            row += len(texts)
            kept = batch.slice(first, len(texts)).select(others)
            names = ["_row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "_codes", "_links"]
            yield pa.RecordBatch.from_arrays([*kept.columns, *columns], [*others, *names])


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """``code``, in how many rows the pair is, and whether that is the most for its id of A."""
    counts = rows.select(F.explode("_codes").alias("code")).groupBy("code").agg(F.count("*").alias("n"))
    # An id of A meets no more ids than B has.
    same_a = Window.partitionBy(F.expr(f"code div {width}"))
    return counts.withColumn("best", F.col("n") == F.max("n").over(same_a))


def align_tokenizers(
    docs: DataFrame, a_path: str, b_path: str, text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """``docs`` without its text, with the numbers of tokens, groups and links, of links whose pair is the
    most frequent of its id of A (``n_best``), the sum of the links' counts, and a digest of the groups."""
    clash = {*RESULTS, "_row", "_codes", "_links", "text"} & (set(docs.columns) - {text})
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    models = []
    for path in (a_path, b_path):
        with open(path, "rb") as file:
            models.append(file.read())
    width = len(loaded(SentencePieces, models[1]).pieces)
    shared = docs.sparkSession.sparkContext.broadcast(models)
    others = [c for c in docs.columns if c != text]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text]
        + ["_row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"]
        + ["_codes array<bigint>, _links array<bigint>"]
    )

    def aligned(batches):
        a_model, b_model = shared.value
        return aligned_batches(batches, others, loaded(BytePairs, a_model), loaded(SentencePieces, b_model))

    rows = docs.select(*others, F.col(text).alias("text")).mapInArrow(aligned, schema)
    rows = materialize(rows, "token-pairs")
    counts = materialize(pair_counts(rows, width), "token-pair-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = F.col("n") * F.lit(capacity) >= F.lit(total)
    common = F.broadcast(counts.where(often))  # no more than ``capacity`` rows
    pairs = rows.select("_row", F.explode(F.arrays_zip("_codes", "_links")).alias("p"))
    pairs = pairs.select("_row", F.col("p._codes").alias("code"), F.col("p._links").alias("links"))
    sums = F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("links")).alias("count_sum")
    rare = pairs.join(common.select("code"), "code", "left_anti").join(counts.where(~often), "code")
    met = pairs.join(common, "code").groupBy("_row").agg(*sums)
    met = met.unionByName(rare.groupBy("_row").agg(*sums)).groupBy("_row")
    met = met.agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    joined = rows.drop("_codes", "_links").join(met, "_row", "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return joined.select(*others, "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")
