"""Phrase collocations against brute force, and the double-array trie by itself."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import llm_fixtures as fx
from landfall.llm import phrases, tries


def plain_collocations(rows, least, top=2000):
    """lang, rank, phrase, a, l, r, n, score of (lang, text) rows, by counting everything."""
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = []
        for phrase, a in f.items():
            if len(phrase) == 1 or a < least:
                continue
            longer = [
                f[q] for q in f
                if len(q) == 3 and len(phrase) == 2 and phrase in (q[:2], q[1:]) and f[q] >= least
            ]
            if any(100 * b >= 50 * a for b in longer):
                continue
            cuts = [(f[phrase[:k]], f[phrase[k:]]) for k in range(1, len(phrase))]
            scores = [10**6 * a * a // (x * y) for x, y in cuts]
            at = scores.index(min(scores))
            found.append((-scores[at], -a, " ".join(phrase).encode(), *cuts[at]))
        for rank, (score, a, phrase, x, y) in enumerate(sorted(found)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, x, y, n[lang], -score))
    return sorted(out)


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize(("block", "trie"), [(10**6, 10**6), (5, 10**6), (10**6, 3)])
def test_awkward_rows_equal_brute_force(spark, block, trie):
    rows = [
        *fx.ROWS,
        (20, "a a a a a, a a a; a a", None, "s"),
        (21, "a a a a a, a a a; a a", "und", "s"),
        (22, "New\tYork  city. new york CITY! new york\nnew york city", "en", "s"),
        (23, "über den Ü\x0bber den\x0cüber\rden ü", "de", "s"),
        (24, "b c d b c d b c d b c b c", "en", "s"),
    ]
    plain = [(r[2], r[1]) for r in rows]
    for least in (2, 3):
        docs = fx.documents(spark, rows)
        got = found(phrases.collocations(docs, least=least, block=block, trie_phrases=trie))
        assert got == plain_collocations(plain, least)
        assert {"und", "en", "es"} <= {r[0] for r in got}


@pytest.mark.parametrize(("block", "trie"), [(10**6, 10**6), (7, 3)])
def test_texts_are_read_four_times_whatever_the_candidates(spark, block, trie):
    """Scans must not grow with the candidates, which grow with the corpus."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(60):
        words = [f"w{k}" for k in rng.integers(0, 12, 60)]
        rows.append((i, " ".join(words), ["en", "de"][i % 2], "s"))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame([(r[2], r[1]) for r in rows], "lang string, text string")
    docs = docs.repartition(3).mapInArrow(counted, docs.schema)
    got = found(phrases.collocations(docs, block=block, trie_phrases=trie))
    assert got == plain_collocations([(r[2], r[1]) for r in rows], 10)
    assert len(got) > 200
    assert read.value == 4 * len(rows)


@pytest.mark.parametrize("least", [2, 3])
def test_phrases_of_one_hash_are_counted_apart(spark, monkeypatch, least):
    """A shard that sees seven different hashes of phrases only tells them apart by tries."""
    joined = phrases._joined

    def clashing(*words):
        return joined(*words) % np.uint64(7) << np.uint64(61)

    monkeypatch.setattr(phrases, "_joined", clashing)
    rng = np.random.default_rng(9)
    rows = [
        (i, " ".join(f"w{k}" for k in rng.integers(0, 9, 25)), ["en", "de"][i % 2], "s")
        for i in range(12)
    ]
    got = found(phrases.collocations(fx.documents(spark, rows), least=least, trie_phrases=11))
    assert got == plain_collocations([(r[2], r[1]) for r in rows], least)


def test_nothing_frequent_and_no_rows(spark):
    assert phrases.collocations(fx.documents(spark, [(1, "a b c", "en", "s")])).count() == 0
    assert phrases.collocations(fx.documents(spark, [])).count() == 0


@pytest.mark.parametrize("task_words", [phrases.TASK_WORDS, 40])
def test_random_texts_equal_brute_force(spark, monkeypatch, task_words):
    monkeypatch.setattr(phrases, "TASK_WORDS", task_words)  # 40: many groups of tasks
    monkeypatch.setattr(phrases, "CHUNK", 64)
    rng = np.random.default_rng(3)
    marks = [" ", " ", " ", " ", "  ", "\t", ", ", ". ", "\n", "; "]
    rows = []
    for i in range(300):
        words = [f"w{k}" for k in np.minimum(rng.zipf(1.4, int(rng.integers(0, 120))), 400)]
        text = "".join(w + marks[rng.integers(len(marks))] for w in words)
        rows.append((i, text, ["en", "de", None][i % 3] if i % 5 else "en", "s"))
    docs = fx.documents(spark, rows).repartition(5)
    expected = plain_collocations([(r[2], r[1]) for r in rows], 10, top=40)
    assert found(phrases.collocations(docs, top=40)) == expected
    assert found(phrases.collocations(docs, top=40, block=50, trie_phrases=9)) == expected
    assert len(expected) == 120


def test_words_of_one_hash_take_another_seed(spark, monkeypatch):
    """Under the first seed all words but one collide, so the work is done under the second."""
    hashes = phrases.span_hashes
    first = phrases.xxhash.xxh64_intdigest(b"en", 0)

    def colliding(view, start, length, seed):
        out = hashes(view, start, length, seed)
        out[(seed == first) & (length > 1)] = 7
        return out

    def words_of(batch, seed, plain=phrases.words_of):
        phrases.span_hashes = colliding
        try:
            return plain(batch, seed)
        finally:
            phrases.span_hashes = hashes

    monkeypatch.setattr(phrases, "words_of", words_of)
    rows = [(i, "big dog big dog a big cat", "en", "s") for i in range(6)]
    got = found(phrases.collocations(fx.documents(spark, rows)))
    assert got == plain_collocations([(r[2], r[1]) for r in rows], 10)
    assert got


def test_scores_beyond_64_bits(spark):
    big = 3 * 10**12
    df = spark.createDataFrame([(big, big + 1, big + 7)], "a long, l long, r long")
    score = df.select(phrases._score("a", "l", "r").alias("s")).first()[0]
    assert score == 10**6 * big * big // ((big + 1) * (big + 7))


@pytest.mark.parametrize("seed", range(6))
def test_trie_counts_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.integers(1, 4000))
    vocabulary = rng.integers(1, 2**63, size).astype("u8")
    sizes = rng.integers(2, 4, int(rng.integers(1, 20_000))).astype("u8")
    words = vocabulary[np.minimum(rng.zipf(1.3, (len(sizes), 3)), size) - 1]
    words[sizes == 2, 2] = 0
    lines = np.unique(np.column_stack([sizes, words]), axis=0)
    sizes, words = lines[:, 0].astype("i8"), np.ascontiguousarray(lines[:, 1:])
    trie = tries.Trie.built(words, sizes)
    text = np.append(vocabulary[np.minimum(rng.zipf(1.3, 5000), size) - 1], np.uint64(5))
    follows = rng.random(len(text)) < 0.8
    follows[-1] = False
    plain = Counter()
    for i in range(len(text)):
        for k in (2, 3):
            if i + k <= len(text) and follows[i : i + k - 1].all():
                plain[(k, *text[i : i + k].tolist(), *[0] * (3 - k))] += 1
    expected = [plain[(int(s), *w.tolist())] for s, w in zip(sizes, words)]
    assert trie.counts(text, follows, 3).tolist() == expected
    # no state shares a place with another
    used = np.flatnonzero(trie.check >= 0)
    assert (trie.base[trie.check[used]] <= used).all()


def test_trie_counts_with_weights_equal_brute_force():
    rng = np.random.default_rng(4)
    vocabulary = rng.integers(1, 2**63, 30).astype("u8")
    lines = np.unique(vocabulary[rng.integers(0, 30, (300, 2))], axis=0)
    trie = tries.Trie.built(lines, np.full(len(lines), 2))
    text, weights = vocabulary[rng.integers(0, 30, 4000)], rng.integers(0, 3, 4000)
    follows = rng.random(4000) < 0.8
    follows[-1] = False
    plain = Counter()
    for i in np.flatnonzero(follows).tolist():
        plain[tuple(text[i : i + 2].tolist())] += int(weights[i])
    expected = [plain[tuple(w.tolist())] for w in lines]
    assert trie.counts(text, follows, 2, weights).tolist() == expected


def test_empty_trie():
    trie = tries.Trie.built(np.empty((0, 3), dtype="u8"), np.empty(0, dtype="i8"))
    assert trie.counts(np.array([1, 2], dtype="u8"), np.array([True, False]), 3).tolist() == []
