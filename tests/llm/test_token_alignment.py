"""Alignment against a plain version on the encoders' own output, counts against dictionaries."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from evenkeel.llm.queries import QUERIES, TOKENIZERS
from evenkeel.llm.token_alignment import BytePairs, align_tokenizers, byte_letters, irregular_groups

A_PATH, B_PATH = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def plain_encoders():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def plain_groups(encoders, text):
    """Groups as lists of ids, by sets of common ends; none where the bytes differ."""
    a_model, b_model = encoders
    if not text:
        return []
    letters, raw = byte_letters(), (" " + text).encode()
    a_ids = a_model.encode(" " + text, add_special_tokens=False).ids
    a_bytes = [bytes(letters[c] for c in a_model.id_to_token(i)) for i in a_ids]
    b_ids = b_model.encode(text)
    entries = [b_model.id_to_piece(i) for i in b_ids]
    b_bytes = [
        bytes([int(e[3:5], 16)]) if b_model.is_byte(i) else e.replace("▁", " ").encode() for i, e in zip(b_ids, entries)
    ]
    if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
        k, m = ends_a.tolist().index(end, i) + 1, ends_b.tolist().index(end, j) + 1
        groups.append((a_ids[i:k], b_ids[j:m]))
        i, j = k, m
    return groups


def plain_result(encoders, texts):
    per_text = [plain_groups(encoders, t) for t in texts]
    linked = [Counter((a, b) for left, right in groups for a in left for b in right) for groups in per_text]
    counts = Counter(pair for links in linked for pair in links)
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for groups, links in zip(per_text, linked):
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((
            sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
            sum(n for (a, b), n in links.items() if counts[a, b] == most[a]), sum(n * counts[p] for p, n in links.items()),
            hashlib.sha256(written.encode()).hexdigest() if groups else "",
        ))
    return out


def random_texts(n, seed=4):
    rng = random.Random(seed)
    parts = [" ", "  ", "\n", "\t", "the", "ing", "Über", "漢字", "🙂", "é", "x", "123", "<s>", "<|endoftext|>", "don't", "\x00", "．", "aaaa"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(n)]


TEXTS = [None, "", " ", "a", "a▁b", "<unk>", "The cat sat on the mat.", "The cat sat on the mat.", "ﬁne １２", "a" * 5000, "ab " * 9000]


def test_equals_plain_version(spark, plain_encoders):
    texts = TEXTS + random_texts(300)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n_tokens int, text string").withColumn("other", F.lit(1))
    for capacity in (1 << 18, 3):  # common pairs only, and nearly none
        got = {r["n_tokens"]: r for r in align_tokenizers(df.repartition(3), A_PATH, B_PATH, capacity=capacity).collect()}
        want = plain_result(plain_encoders, texts)
        assert len(got) == len(texts)
        for i, row in enumerate(want):
            assert tuple(got[i][c] for c in COLUMNS) == row, texts[i]
            assert got[i]["other"] == 1


def test_literal_space_sign_has_no_tokens(spark, plain_encoders):
    assert plain_groups(plain_encoders, "a▁b") == []


@pytest.mark.parametrize("seed", range(20))
def test_skipping_equals_common_ends(seed):
    rng = random.Random(seed)
    n = rng.choice([1, 5, 300])
    cut = lambda share: sorted({x for x in range(1, n) if rng.random() < share} | {n})
    a, b = cut(rng.random()), cut(rng.random())
    if seed % 3 == 0:
        b = a  # one stretch to the end
    common = sorted(set(a) & set(b))
    groups, i, j = [], 0, 0
    for end in common:
        k, m = a.index(end) + 1, b.index(end) + 1
        groups.append((i, k, j, m))
        i, j = k, m
    assert irregular_groups(np.array(a), np.array(b)) == [g for g in groups if (g[1] - g[0], g[3] - g[2]) != (1, 1)]


def test_ranks_equal_merges(plain_encoders):
    ours = BytePairs(open(A_PATH, "rb").read())
    texts = random_texts(3000, seed=9)
    theirs = plain_encoders[0].encode_batch([" " + t for t in texts], add_special_tokens=False)
    assert [x.tolist() for x in ours.encode(texts)] == [t.ids for t in theirs]


def test_merges_out_of_order_are_refused():
    spec = b'{"added_tokens": [], "model": {"vocab": {"a": 0, "b": 1, "ab": 3, "ba": 2}, "merges": ["a b", "b a"]}}'
    with pytest.raises(ValueError):
        BytePairs(spec)


def test_query(spark, sf, plain_encoders):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op13_token_alignment"](spark, sf).collect()}
    ids = sorted(texts)
    want = plain_result(plain_encoders, [texts[i] for i in ids])
    assert len(got) == len(ids)
    for i, row in zip(ids, want):
        assert tuple(got[i][c] for c in COLUMNS) == row


def test_empty_table_and_clash(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert align_tokenizers(empty, A_PATH, B_PATH).count() == 0
    with pytest.raises(ValueError):
        align_tokenizers(spark.createDataFrame([("a", 1)], "text string, n_links int"), A_PATH, B_PATH)
