"""Word vectors learned in shares of the texts."""

import heapq
import random

import numpy as np
import pyarrow as pa

from pagesieve.operators import skipgram
from pagesieve.operators.vocabulary import learn_vectors, number_words, word_frequencies


def test_paths_are_those_of_an_optimal_tree():
    draw = random.Random(3)
    for n in (1, 2, 3, 7, 60, 400):
        weights = sorted(draw.choice([5, 5, 5, 6, 7, 9, draw.randint(5, 5000)]) for _ in range(n))
        runs = [(weight, weights.count(weight)) for weight in sorted(set(weights))]
        tree = skipgram.huffman(runs)
        leaf, node, child = tree.paths(np.arange(n))
        cost, heap = 0, list(weights)
        heapq.heapify(heap)
        while len(heap) > 1:
            merged = heapq.heappop(heap) + heapq.heappop(heap)
            cost += merged
            heapq.heappush(heap, merged)
        assert sum(weights[at] for at in leaf.tolist()) == cost
        # Every inner node has two children, and no two leaves the same path.
        assert len(set(node.tolist())) == n - 1
        paths = [tuple(zip(node[leaf == at].tolist(), child[leaf == at].tolist(), strict=True)) for at in range(n)]
        assert len(set(paths)) == n and all(node == 2 * n - 2 for node, _ in (path[-1] for path in paths if path))
        # Told for some leaves alone, as a task asks for them.
        some = np.array(sorted(draw.sample(range(n), (n + 1) // 2)))
        again = tree.paths(some)
        assert all(list(zip(again[1][again[0] == at], again[2][again[0] == at], strict=True)) == list(paths[of]) for at, of in enumerate(some))


def test_the_tree_is_told_by_frequencies_not_by_words():
    tree = skipgram.huffman([(5, 3_000_000), (6, 1_000_001), (40, 999), (100_000, 1)])
    assert tree.n_leaves == 4_001_001 and len(tree.first) < 1000
    assert tree.paths(np.array([4_001_000]))[1][-1] == 2 * tree.n_leaves - 2


def test_a_step_goes_down_the_slope_of_every_pair(monkeypatch):
    """Against one pair of words and one inner node after the other, as steps get small."""
    monkeypatch.setattr(skipgram, "RATE", 1e-4)
    words = pa.array([f"w{at}" for at in range(6)], pa.large_string())
    tree = skipgram.huffman([(3, 2), (4, 3), (9, 1)])
    share = skipgram.Share(words, np.arange(6), tree, 8, 1, 7, 0, 1, 10**9)
    share.inner[:] = np.random.default_rng(1).normal(size=share.inner.shape)
    vectors, inner = share.vectors.astype(float).copy(), share.inner.astype(float).copy()
    before, nodes_before = vectors.copy(), inner.copy()
    texts = [[0, 1, 5, 2], [3, 4, 5, 5, 1]]
    for text in texts:
        for at, word in enumerate(text):
            for near in (at - 1, at + 1):  # a window of one has no shorter reach
                if not 0 <= near < len(text):
                    continue
                of, total = text[near], np.zeros(8)
                for place in range(share.begin[word], share.begin[word + 1]):
                    node, right = share.node[place], share.right[place]
                    slope = 1e-4 * (right - 1 / (1 + np.exp(-vectors[of] @ inner[node])))
                    total += slope * inner[node]
                    inner[node] += slope * vectors[of]
                vectors[of] += total
    share.train(np.array([4, 5]), np.array([0, 1, 5, 2, 3, 4, 5, 5, 1]), 1000)
    assert share.trained.all()
    assert np.allclose(share.vectors - before, vectors - before, atol=2e-6)
    assert np.allclose(share.inner - nodes_before, inner - nodes_before, atol=2e-6)


def test_sentences_end_with_texts_and_after_the_longest():
    words = pa.array(["a", "b"], pa.large_string())

    def trained(sizes, places, longest):
        share = skipgram.Share(words, np.arange(2), skipgram.huffman([(2, 2)]), 4, 2, 1, 0, 1, 100)
        share.train(np.array(sizes), np.array(places), longest)
        return share.trained.tolist()

    assert trained([1, 1], [0, 1], 1000) == [False, False]  # no word has a neighbour
    assert trained([2], [0, 1], 1) == [False, False]
    assert trained([3], [0, -1, 1], 1000) == [True, True]  # unknown words leave no gap
    assert trained([0, 2, 0], [0, 1], 1000) == [True, True]
    assert trained([2], [-1, -1], 1000) == [False, False]


def test_a_word_repeated_without_end_keeps_its_vector_small():
    words = pa.array(["a", "b", "c"], pa.large_string())
    share = skipgram.Share(words, np.arange(3), skipgram.huffman([(5, 1), (6, 1), (20000, 1)]), 8, 5, 1, 0, 1, 20011)
    share.train(np.array([20000]), np.array([2] * 19000 + [0, 1, 2, 2] * 250), 1000)
    assert np.isfinite(share.vectors).all() and np.abs(share.vectors).max() < 20


def test_vectors_are_learned_without_a_vocabulary_on_the_driver(spark, monkeypatch):
    """Spark ML's Word2Vec gathers the vocabulary and all vectors on the driver."""
    import pyspark.ml.feature

    monkeypatch.setattr(pyspark.ml.feature, "Word2Vec", None)
    monkeypatch.setattr(skipgram, "BLOCK_WORDS", 500)
    draw = random.Random(5)
    fill = [f"f{at}" for at in range(30)]
    rows = []
    for at in range(1200):
        rows.append((at, ["the", "small", draw.choice(["cat", "kitten"]), "purrs", "softly", *draw.sample(fill, 3), None, f"rare{at}"]))
        rows.append((2000 + at, ["the", "loud", "engine", "roars", "hard", *draw.sample(fill, 3)]))
    rows += [(5000, None), (5001, []), (5002, ["alone"]), *((6000 + at, ["single"]) for at in range(5))]
    texts = spark.createDataFrame(rows, "doc_id long, words array<string>").repartition(3)
    vocabulary = number_words(word_frequencies(texts, "words"))

    def learned():
        found = learn_vectors(texts, "words", vocabulary, size=16, min_count=5, window=3, seed=1, partitions=3)
        return {row["word"]: (row["id"], np.array(row["vector"])) for row in found.collect()}

    first, again = learned(), learned()
    counts = {row["word"]: (row["freq"], row["id"]) for row in vocabulary.collect()}
    assert {word: at for word, (at, _) in first.items()} == {word: at for word, (n, at) in counts.items() if n >= 5}
    assert all(np.array_equal(first[word][1], again[word][1]) for word in first)
    assert 0 < np.abs(first["single"][1]).max() <= 0.5 / 16  # never beside another: as it began

    def cos(a, b):
        a, b = first[a][1], first[b][1]
        return float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))

    assert cos("cat", "kitten") > cos("cat", "engine") + 0.2
