"""Sampling without replacement against the enumerated segmentations of small lattices."""
import zlib
from collections import Counter

import numpy as np
import pytest

from eventide.llm import op1_sentencepiece as op1
from eventide.llm.common import vocabulary
from eventide.llm.lattice import Lattices, Vocabulary, mixed, spelled, units

MODEL = vocabulary("piece_bpe_32k.model")


def small():
    pieces = ["", "▁", "a", "b", "ab", "▁a", "ba", "▁ab", "bab"]
    weights = [0.0, -1.0, -1.5, -1.2, -2.0, -2.2, -1.8, -2.9, -2.5]
    return Vocabulary(pieces, weights, [9] * 256)


def enumerate_paths(v, text):
    """All segmentations (ids) of a text with their weights."""
    done = {}

    def go(at, ids, w):
        if at == len(text):
            done[tuple(ids)] = w
        for i, p in enumerate(v.pieces):
            if p and text.startswith(p, at):
                go(at + len(p), ids + [i], w + v.weight[v.ends.tolist().index(i)])
    go(0, [], 0.0)
    return done


def bare_sampler(v):
    own = object.__new__(op1.Sampler)
    own.vocabulary, own.lattices = v, Lattices(v)
    return own


def test_probabilities_are_those_of_the_paths():
    v = small()
    own = bare_sampler(v)
    paths = enumerate_paths(v, "▁abab▁ba")
    whole = np.log(sum(np.exp(w) for w in paths.values()))
    seen = {}
    for key in range(400):
        (samples, _), = own.samples(["▁abab▁ba"], mixed(np.array([key], np.uint64)), 1)
        seen[tuple(own.lattices.ids(samples[0].arcs).tolist())] = samples[0].log_prob
    assert len(seen) > 10
    for ids, log_prob in seen.items():
        assert log_prob == pytest.approx(paths[ids] - whole, abs=1e-4)


def test_order_and_inclusion_are_those_of_gumbel_top_k():
    """Samples are drawn one after the other without replacement: by probability, then by what is left."""
    v = small()
    own = bare_sampler(v)
    paths = enumerate_paths(v, "▁abab")
    whole = sum(np.exp(w) for w in paths.values())
    p = {ids: np.exp(w) / whole for ids, w in paths.items()}
    n = 6000
    keys = mixed(np.arange(n, dtype=np.uint64))
    first, pairs = Counter(), Counter()
    for samples, beyond in own.samples(["▁abab"] * n, keys, 3):
        ids = [tuple(own.lattices.ids(s.arcs).tolist()) for s in samples]
        assert len(set(ids)) == 3
        values = [s.perturbed for s in samples]
        assert values == sorted(values, reverse=True) and values[-1] > beyond
        first[ids[0]] += 1
        pairs[tuple(ids[:2])] += 1
    for ids, q in p.items():
        assert first[ids] / n == pytest.approx(q, abs=4 * (q / n) ** 0.5 + 1e-3)
    for a, pa in p.items():
        for b, pb in p.items():
            if a != b:
                q = pa * pb / (1 - pa)
                assert pairs[a, b] / n == pytest.approx(q, abs=4 * (q / n) ** 0.5 + 1e-3)


def test_all_segmentations_when_there_are_fewer_than_k():
    v = small()
    own = bare_sampler(v)
    for text in ("▁ab", "▁a", "▁abab", ""):
        paths = enumerate_paths(v, text)
        (samples, beyond), = own.samples([text], np.array([5], np.uint64), 50)
        assert {tuple(own.lattices.ids(s.arcs).tolist()) for s in samples} == set(paths) and len(samples) == len(paths)
        assert beyond == -np.inf and sum(np.exp(s.log_prob) for s in samples) == pytest.approx(1.0, abs=1e-4)


def test_a_text_among_others_is_sampled_alike():
    own = op1.Sampler(MODEL)
    texts = [own.normalised(t) for t in ("The first text, with words.", "", "zweite Zeile\nmit Umbruch 漢字 🙂", "  blanks   here ")]
    keys = mixed(np.arange(4, dtype=np.uint64))
    together = own.samples(texts, keys, 3)
    for d in range(4):
        (alone, _), = op1.Sampler(MODEL).samples(texts[d:d + 1], keys[d:d + 1], 3)
        assert [s.perturbed for s in alone] == [s.perturbed for s in together[d][0]]


def test_units_spell_the_text():
    for t in ("▁a▁b", "▁▁a", "▁", "▁a▁▁b▁", "a▁b", "▁a\n▁▁b"):
        assert "".join(map(spelled, units(t))) == t or not t.startswith("▁")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, sample int, key string")


def test_query_and_decoding(spark):
    rows = [(1, "Some words to cut, in pieces."), (2, None), (3, ""), (4, "naïve 漢字 🙂\nline\ttab  two blanks "), (4, "naïve"), (None, "no id"), (None, "no id"),
            (5, "x" * 5000), (6, "Some words to cut, in pieces.")]
    got = op1.sample_segmentations(frame(spark, rows).repartition(3), MODEL, k=4, with_ids=True)
    back = op1.decode(got, MODEL).collect()
    by = {}
    for r in back:
        assert r.n_pieces == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and 0 <= r.inclusion <= 1
        by.setdefault((r.doc_id, r.row), []).append(r)
    assert len(by) == len(rows)
    for (i, _), own in by.items():
        want = {t or "" for j, t in rows if j == i}
        own.sort(key=lambda r: r.sample)
        assert len({tuple(r.ids) for r in own}) == len(own) == (1 if want == {""} else 4)
        assert {r.text for r in own} <= want
        assert [r.perturbed for r in own] == sorted((r.perturbed for r in own), reverse=True)
    digests = {k: [r.ids_crc32 for r in v] for k, v in by.items()}
    assert len({tuple(v) for k, v in digests.items() if k[0] is None}) == 1        # repeated rows are sampled alike
    assert len({tuple(v) for k, v in digests.items() if k[0] in (1, 6)}) == 2      # equal texts of other ids are not
    again = op1.sample_segmentations(frame(spark, rows).coalesce(1), MODEL, k=4).collect()
    assert sorted((r.doc_id or -1, r.sample, r.ids_crc32) for r in again) == sorted((r.doc_id or -1, r.sample, r.ids_crc32) for r in back)
    assert op1.sample_segmentations(frame(spark, []), MODEL).collect() == []
