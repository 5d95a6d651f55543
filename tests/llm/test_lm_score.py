from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from kerbside.llm import lm_score as m
from kerbside.llm.text import words

from .cases import awkward, rows, with_clashes


SHAPE = m.Shape()


def chain(seed: int, n: int) -> str:
    """Text in which a word's neighbours say what it is."""
    r = random.Random(seed)
    at, out = r.randrange(50), []
    for _ in range(n):
        out.append(f"w{at}")
        at = (at + 1) % 50 if r.random() < 0.95 else r.randrange(50)
    return " ".join(out)


def test_fluent_text_scores_above_shuffled_text(spark):
    texts = [chain(i, 400) for i in range(60)]
    shuffled = [" ".join(random.Random(i).sample(t.split(), 400)) for i, t in enumerate(texts[:20])]
    got = {r.doc_id: r for r in m.score_pseudo_likelihood(with_clashes(rows(spark, texts + shuffled))).collect()}
    fluent = [got[i].mean_log_likelihood for i in range(20)]
    mixed = [got[60 + i].mean_log_likelihood for i in range(20)]
    assert np.mean(fluent) > np.mean(mixed) + 0.3
    assert all(r.n_tokens == 400 and r.log_likelihood == pytest.approx(400 * r.mean_log_likelihood) for r in got.values())


def test_awkward_rows(spark):
    df = rows(spark, awkward())
    got = m.score_pseudo_likelihood(with_clashes(df)).collect()
    assert len(got) == df.count() and all(np.isfinite(r.log_likelihood) and r.log_likelihood <= 0 for r in got)
    none = [r for r in got if r.n_tokens == 0]
    assert len(none) == 4 and all(r.log_likelihood == 0 and r.mean_log_likelihood is None for r in none)
    assert m.score_pseudo_likelihood(rows(spark, [])).collect() == []


def test_words_that_share_a_token_score_by_their_own_counts(spark):
    names = [f"rare{i}" for i in range(400)]
    token = words(pa.array([" ".join(names)]))[0] % np.uint64(SHAPE.shared)
    often, once = (names[i] for i in np.flatnonzero(token == token[0])[:2])
    common = " ".join(f"w{i}" for i in range(SHAPE.size - SHAPE.shared))
    texts = [common] * 6 + [f"w1 w2 w3 {x} w4 w5" for x in (often, once)] + [f"w7 {often} w8"] * 3
    got = {r.doc_id: r for r in m.score_pseudo_likelihood(rows(spark, texts)).collect()}
    assert got[6].log_likelihood - got[7].log_likelihood == pytest.approx(np.log(4))


def network():
    r = np.random.default_rng(4)
    net = m.WindowNetwork(SHAPE)
    net.flat[:] = r.normal(0, 0.3, len(net.flat))
    return net


def test_probabilities_add_up_to_one():
    net, padded = network(), np.full(5, SHAPE.pad, np.int32)
    padded[[1, 3]] = 7
    total = 0.0
    for token in range(SHAPE.size):
        padded[2] = token
        total += float(np.exp(net.log_probabilities(padded, np.array([2])))[0])
    assert total == pytest.approx(1, abs=1e-3)


def test_training_lowers_the_loss():
    net = network()
    r = np.random.default_rng(1)
    padded = np.tile(r.integers(0, 30, 40), 100).astype(np.int32)
    at = np.arange(2, len(padded) - 2)
    before = net.log_probabilities(padded, at).mean()
    seen = m.WindowNetwork(SHAPE, np.zeros_like(net.flat))
    for _ in range(10):
        net.train(padded, at, seen)
    assert net.log_probabilities(padded, at).mean() > before + 1


def test_batches_do_not_change_scores(monkeypatch):
    net = network()
    padded = np.random.default_rng(2).integers(0, SHAPE.size, 500).astype(np.int32)
    at = np.arange(2, 498)
    want = net.log_probabilities(padded, at)
    monkeypatch.setattr(m, "_CHUNK", 37)
    assert np.allclose(net.log_probabilities(padded, at), want, atol=1e-4)


def test_every_position_is_masked_once():
    r = np.random.default_rng(7)
    lengths = r.integers(0, 9, 200)
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    place = np.arange(offsets[-1]) * 3 + 2
    marks = r.integers(0, 2**62, 200)
    seen = np.concatenate([m.masked_places(place, offsets, marks, turn) for turn in range(m.ROUNDS)])
    assert sorted(seen) == list(place)


def test_scores_do_not_depend_on_the_split(spark, monkeypatch):
    monkeypatch.setattr(m, "BUCKET_TOKENS", 3_000)  # several replicas
    texts = [chain(i, 50 + 7 * i) for i in range(60)]
    scores, networks = [], []
    for n in (2, 16):
        df = rows(spark, texts).repartition(n)
        networks.append(m.train(df)[1])
        scores.append({r.doc_id: r.log_likelihood for r in m.score_pseudo_likelihood(df).collect()})
    assert (networks[0] == networks[1]).all()
    assert scores[0].keys() == scores[1].keys()
    # one network; what is left is the rounding of 32-bit products over batches of other sizes
    assert all(scores[0][i] == pytest.approx(scores[1][i], rel=1e-5) for i in scores[0])


def test_pads_are_trained_on_both_sides(spark):
    _, flat, _ = m.train(rows(spark, [chain(i, 30) for i in range(200)]))
    before = m.WindowNetwork(SHAPE, share=np.full(SHAPE.size, 1 / SHAPE.size)).part["place"]
    after = m.WindowNetwork(SHAPE, flat).part["place"]
    moved = [float(np.abs(after[k][SHAPE.pad] - before[k][SHAPE.pad]).max()) for k in range(4)]
    assert min(moved) > 0.05


def test_tokens_follow_the_vocabulary():
    sizes = [m.shape_of(n).size for n in (0, 1 << 20, 1 << 21, 1 << 24, 1 << 28, 1 << 40)]
    assert sizes == [2048, 2048, 4096, 8192, 32768, 32768]


def test_scores_equal_a_plain_sum(spark):
    """Each token's probability worked out one at a time from the network's numbers."""
    texts = [chain(i, 25) for i in range(40)] + ["lone", "two words"]
    df = rows(spark, texts)
    vocabulary, flat, rare = m.train(df)
    part, shape = m.WindowNetwork(vocabulary.shape, flat.copy()).part, vocabulary.shape
    counts = {r["word"]: r["count"] for r in rare.collect()}
    got = {r.doc_id: r.log_likelihood for r in m.score_pseudo_likelihood(df).collect()}
    for i, text in enumerate(texts):
        hashes = words(pa.array([text]))[0]
        tokens = [shape.pad] * 2 + vocabulary.tokens(hashes).tolist() + [shape.pad] * 2
        total = 0.0
        for at in range(2, len(tokens) - 2):
            h = np.tanh(part["bias"] + sum(part["place"][k][tokens[at + s]] for k, s in enumerate(m.PLACES)))
            first, second = divmod(tokens[at], shape.members)
            for logits, chosen in ((h @ part["class"] + part["class_bias"], first), (h @ part["member"][first] + part["member_bias"][first], second)):
                total += float(logits[chosen] - np.log(np.exp(logits - logits.max()).sum()) - logits.max())
            if tokens[at] < shape.shared:
                total += math.log(counts.get(int(hashes[at - 2].view(np.int64)), 1) / vocabulary.room[tokens[at]])
        assert got[i] == pytest.approx(total, abs=1e-3)


def test_a_batch_moves_every_part_once_by_its_plain_slope(monkeypatch):
    """Slopes are worked out one place at a time; a part is moved once a batch, not once for every class."""
    net, calls, move = network(), [], m.WindowNetwork._move
    monkeypatch.setattr(m.WindowNetwork, "_move", lambda self, seen, name, *rest: (calls.append(name), move(self, seen, name, *rest)))
    padded = np.full(304, SHAPE.pad, np.int32)
    padded[2:-2] = np.random.default_rng(3).integers(0, 300, 300)
    at = np.arange(2, 302)
    before = m.WindowNetwork(SHAPE, net.flat.copy()).part
    slopes = m.WindowNetwork(SHAPE, np.zeros_like(net.flat)).part
    for i in at:
        near = [padded[i + s] for s in m.PLACES]
        h = np.tanh(before["bias"] + sum(before["place"][k][t] for k, t in enumerate(near)))
        first, second = divmod(int(padded[i]), SHAPE.members)
        dh = np.zeros_like(h)
        for weights, bias, chosen, w, b in (
            (before["class"], before["class_bias"], first, slopes["class"], slopes["class_bias"]),
            (before["member"][first], before["member_bias"][first], second, slopes["member"][first], slopes["member_bias"][first]),
        ):
            e = np.exp(h @ weights + bias)
            e /= e.sum()
            e[chosen] -= 1
            w += np.outer(h, e) / len(at)
            b += e / len(at)
            dh += weights @ e
        dh *= (1 - h * h) / len(at)
        slopes["bias"] += dh
        for k, t in enumerate(near):
            slopes["place"][k][t] += dh
    seen = m.WindowNetwork(SHAPE, np.zeros_like(net.flat))
    net.train(padded, at, seen)
    assert sorted(calls) == sorted(set(calls))
    for name, slope in slopes.items():
        assert np.allclose(seen.part[name], slope * slope, rtol=1e-2, atol=1e-9), name
        clear = np.abs(slope) > 1e-4
        want = before[name] - m._RATE * slope / np.sqrt(slope * slope + 1e-10)
        assert np.allclose(net.part[name][clear], want[clear], atol=1e-3), name
        assert (net.part[name][slope == 0] == before[name][slope == 0]).all()
