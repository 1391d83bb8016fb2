"""Token counts and alignment against the tokenizer libraries on whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import llm_fixtures as fx
from landfall.llm import alignment, queries, token_counts
from landfall.llm.tokens import as_ids, tokenizer_path

SMALL = "/root/testdata/sf0.001"

ODD = [
    *"abcdesSTtrevmldD'''    \t\n..!?012²½éÉßµªÿ×÷\xa0\x85\x1c\x00<|>",
    "<|endoftext|>", "<|startoftext|>", "</s>", "<s>", "<0x41>", "œ", "😀", "İ", "Σς", "é", "́",
    "’s", "中", "▁", "　", "​", "﻿", "the ", " and", "ing", "'ll", "'re", " ",
]


def odd_texts(count, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 50))) for _ in range(count)]
    return [*texts, None, "", " ", "  ", "a  b ", "▁", "a", "'", "s'", "it's 'sam \"'s ''s 's's"]


@pytest.fixture(scope="module")
def word_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


def plain_count(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_latin_characters_are_split_as_by_the_tokenizer(word_tokenizer):
    for code in range(256):
        letter = chr(code)
        for text in (f"a{letter}a", f"!{letter}!", f"1{letter}1", letter.join("ab1!")):
            data, odd = token_counts.plain_part(text)
            assert not odd
            start, length = token_counts.pre_tokens(data)
            got = [data[a : a + n].decode("latin-1") for a, n in zip(start, length)]
            normal = word_tokenizer.normalizer.normalize_str(text)
            split = word_tokenizer.pre_tokenizer.pre_tokenize_str(normal)
            assert got == [normal[a:b] for _, (a, b) in split], text


def test_counts_of_odd_texts(word_tokenizer):
    path = tokenizer_path("word_bpe_49k.json")
    memory = token_counts.remembered(path)
    words = [b"the", b"and", b"a", b"'s", b"!?", b"sixteen_letters!"]
    for held in (words, []):
        table = token_counts.HashTable.built(held, [memory[w] for w in held])
        texts = [t or "" for t in odd_texts(5000, 1)]
        got = token_counts.counted(texts, table, memory).tolist()
        assert got == [plain_count(word_tokenizer, t) for t in texts]
    assert token_counts.counted([], table, memory).tolist() == []


def test_hash_table_holds_what_it_was_given():
    rng = random.Random(2)
    words = sorted({bytes(rng.choices(range(1, 256), k=rng.randint(1, 16))) for _ in range(5000)})
    counts = [1 + i % 60_000 for i in range(4000)]
    table = token_counts.HashTable.built(words[:4000], counts)
    view = token_counts.lanes(b"".join(words))
    length = np.array([len(w) for w in words])
    start = np.cumsum(length) - length
    low, high = (token_counts.lane(view, start, length, n) for n in range(2))
    assert table.looked_up(low, high).tolist() == counts + [0] * (len(words) - 4000)


@pytest.mark.parametrize("frequent", [4000, 0])
def test_token_counts_of_awkward_rows(spark, monkeypatch, word_tokenizer, frequent):
    monkeypatch.setattr(token_counts, "GENERATION", 7)
    plan = token_counts.frequent_lengths
    monkeypatch.setattr(
        token_counts, "frequent_lengths", lambda docs, path: plan(docs, path, most=frequent)
    )
    got = token_counts.count_tokens(fx.documents(spark), limit=50)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = []
    for doc_id, text, *_ in fx.ROWS:
        n = plain_count(word_tokenizer, text)
        expected.append((doc_id, len((text or "").encode()), n, n > 50))
    assert fx.multiset(got.collect()) == fx.multiset(expected)
    assert token_counts.count_tokens(fx.documents(spark, [])).count() == 0


def test_token_counts_query_equals_the_library(spark, word_tokenizer):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = []
    for doc_id, text in rows:
        n = plain_count(word_tokenizer, text)
        expected.append((doc_id, len((text or "").encode()), n, n > 2048))
    got = queries.op12_token_counts(spark, SMALL).collect()
    assert fx.multiset(got) == fx.multiset(expected)


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(tokenizer_path(alignment.FILE_A), tokenizer_path(alignment.FILE_B))


@pytest.fixture(scope="module")
def plain_align(pair):
    """(n_a, n_b, digest, links) of a text by the libraries and a walk over both sides' ends."""
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(alignment.FILE_A))
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(alignment.FILE_B))

    def piece(i):
        name = model.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()

    def walk(text):
        nothing = (0, 0, "", [])
        if not text:
            return nothing
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids
        b = model.encode(text)
        bytes_a, bytes_b = [pair.a.pieces[i] for i in a], [piece(i) for i in b]
        whole = (" " + text).encode()
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            return nothing
        groups, links, i, j, end_a, end_b, from_a, from_b = [], [], 0, 0, 0, 0, 0, 0
        while i < len(a):
            if end_a <= end_b:
                end_a, i = end_a + len(bytes_a[i]), i + 1
            while end_b < end_a:
                end_b, j = end_b + len(bytes_b[j]), j + 1
            if end_a == end_b:
                left, right = ",".join(map(str, a[from_a:i])), ",".join(map(str, b[from_b:j]))
                groups.append(f"{left}|{right}")
                links.append((a[i - 1], b[j - 1]))
                from_a, from_b = i, j
        return len(a), len(b), hashlib.sha256(";".join(groups).encode()).hexdigest(), links

    return walk


def test_alignment_of_odd_texts(pair, plain_align):
    texts = odd_texts(4000, 5)
    found = alignment.aligned(pair, texts)
    got = [(a, b, d, [(int(x) >> 16, int(x) & 0xFFFF) for x in n]) for a, b, d, n in found]
    assert got == [plain_align(t) for t in texts]
    assert 0 < sum(g[0] == 0 for g in got) < len(got)
    assert alignment.aligned(pair, []) == []


def test_every_byte_comes_back(pair):
    text = "".join(map(chr, range(1, 300))) + "\U0010ffff"
    a, b = (ids.tolist() for ids in alignment.separated(as_ids(pair.ids(text))))
    for side, ids in ((pair.a, a), (pair.b, b)):
        assert b"".join(side.pieces[i] for i in ids) == b" " + text.encode()


def test_shared_cuts_are_all_common_ends():
    rng = np.random.default_rng(0)
    for _ in range(300):
        lengths = rng.integers(1, 40, int(rng.integers(1, 8)))
        bounds = np.cumsum(lengths)
        sides = []
        for _ in range(2):
            inner = np.flatnonzero(rng.random(bounds[-1]) < rng.random()) + 1
            sides.append(np.unique(np.concatenate([inner, bounds])))
        last = [np.searchsorted(s, bounds) + 1 for s in sides]
        cuts = alignment.shared_cuts(*sides, *last)
        common = np.intersect1d(*sides)
        assert sides[0][cuts[0] - 1].tolist() == sides[1][cuts[1] - 1].tolist() == common.tolist()


def test_different_pairs_are_bounded_by_the_vocabularies(pair):
    known = defaultdict(int)
    for piece in pair.b.pieces:
        known[piece] += 1
    assert len(pair.a.pieces) <= alignment.most_pairs(pair) < 2**20


def plain_rows(rows, plain_align):
    found = [(doc_id, plain_align(text)) for doc_id, text in rows]
    counts = Counter(link for _, one in found for link in one[3])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (doc_id, a, b, len(links), len(links), sum(counts[x] == best[x[1]] for x in links),
         sum(counts[x] for x in links), digest)
        for doc_id, (a, b, digest, links) in found
    ]


def test_alignment_of_awkward_rows(spark, plain_align):
    got = alignment.align(fx.documents(spark))
    assert got.columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    ]
    expected = plain_rows([(r[0], r[1]) for r in fx.ROWS], plain_align)
    assert fx.multiset(got.collect()) == fx.multiset(expected)
    assert alignment.align(fx.documents(spark, [])).count() == 0


def test_alignment_query_equals_brute_force(spark, plain_align):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op13_alignment(spark, SMALL).collect()
    assert fx.multiset(got) == fx.multiset(plain_rows(map(tuple, rows), plain_align))
