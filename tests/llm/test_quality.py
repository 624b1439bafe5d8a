from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from streakline.llm.quality import UNIT, QualityParams, _estimates, quality, verdicts

SCHEMA = "doc_id bigint, text string, lang string, source string, kept string, `group` int, x0 string"
CASES = [None, "", " \t\n", "one two", "a b c d e " * 4, "a\nb\na\n \n\nb b\n a\na", "Ä#ö $$ x|y <z> 100% &\x0b*", "w " * 30_000, "same words here again now " * 2 + "and ten other ones that never come back again at all"]


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    base = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))
    return (*base, base[0] < 10 or 100 * base[4] > 20 * base[0])


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_on_cases_and_documents(spark, sf_dir):
    texts = CASES + [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs = spark.createDataFrame([(i, t, None if i % 3 else "en", "s", "x", 1, "") for i, t in enumerate(texts)], SCHEMA)
    got = quality(docs.repartition(4))
    assert set(docs.columns) <= set(got.columns) and len(set(got.columns)) == len(got.columns)
    found = {r["doc_id"]: tuple(r[c] for c in BASE) for r in got.collect()}
    assert found == {i: brute(t) for i, t in enumerate(texts)}


def test_outliers_per_group(spark):
    """A third of the rows in one source, a tenth of them junk; both partitionings give the same distances."""
    rng = random.Random(3)
    texts = {}
    rows = []
    for i in range(900):
        lang = "en" if i % 3 else "de"
        words = ["".join(rng.choice("aeiounst") for _ in range(max(1, round(rng.gauss(5 if lang == "en" else 8, 2))))) for _ in range(rng.randint(40, 400))]
        junk = i % 10 == 0
        if junk:
            words = [w + rng.choice(["$$$", "###"]) for w in words] if i % 20 else [w.upper() + "aaaaaaa" for w in words]
        texts[i] = junk
        rows.append((i, " ".join(words), lang, "hot" if i % 3 == 1 else f"s{i % 4}", "", 0, ""))
    docs = spark.createDataFrame(rows, SCHEMA)
    one = {r["doc_id"]: (r["kept"], r["distance2"]) for r in verdicts(docs.repartition(7)).collect()}
    two = {r["doc_id"]: (r["kept"], r["distance2"]) for r in verdicts(docs.coalesce(1)).collect()}
    assert one == two
    assert all(one[i][0] != texts[i] for i in texts)


def test_distance_is_that_of_the_subset(spark):
    """With ``share`` 1 and one step the estimate is the plain covariance plus the floors."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        words = ["w" * int(rng.integers(2, 9)) for _ in range(int(rng.integers(210, 300)))]
        for _ in range(int(rng.integers(0, 6))):
            words[int(rng.integers(0, 200))] += "#"
        rows.append((i, " ".join(words), "en", "s", "", 0, ""))
    params = QualityParams(share=1.0, consistency=1.0, steps=1)
    got = sorted(verdicts(spark.createDataFrame(rows, SCHEMA), params=params).collect(), key=lambda r: r["doc_id"])
    mean = np.array([r["word_chars"] / r["n_words"] for r in got])
    centre = (np.floor(np.sort(mean)[149] * 16) + 0.5) / 16
    x = np.round(
        np.stack(
            [
                np.sqrt(200) * (mean - centre),
                np.log1p([100 * r["n_symbols"] / r["n_words"] for r in got]),
                np.log1p([r["n_dup_lines"] for r in got]),
                [r["n_repeat_words"] / r["n_words"] for r in got],
            ],
            axis=1,
        ),
        4,
    )
    centred = x - x.mean(axis=0)
    covariance = centred.T @ centred / len(x) + np.diag(np.square(params.floors))
    expected = np.einsum("ij,jk,ik->i", centred, np.linalg.inv(covariance), centred)
    passed = [i for i, r in enumerate(got) if not r["base_failed"]]
    assert passed == list(range(300))
    assert np.allclose([r["distance2"] for r in got], expected, rtol=1e-3, atol=1e-3)


def test_empty(spark):
    assert quality(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_third_of_a_group_is_junk(spark):
    """One way or two ways of junk in the same group, near or far; the fixed limits pass all of it."""
    rng = random.Random(5)
    junk, rows = {}, []
    for i in range(900):
        source = ("near", "far", "mixed")[i // 300]
        words = ["".join(rng.choice("aeiounst") for _ in range(max(1, round(rng.gauss(5, 2))))) for _ in range(rng.randint(60, 300))]
        junk[i] = i % 3 == 0
        if junk[i] and source == "mixed" and i % 2:
            words = [w + "aaaaaaa" for w in words]
        elif junk[i]:
            words = [w + "$" * (1 if source == "near" else 40) for w in words]
        rows.append((i, " ".join(words), "en", source, "", 0, ""))
    got = {r["doc_id"]: r for r in verdicts(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert all(got[i]["kept"] != junk[i] for i in junk)


def _plain_factor(x, params):
    mean = x.mean(axis=0)
    covariance = (x.T @ x / len(x) - np.outer(mean, mean)) * params.consistency
    factor = np.zeros((4, 4))
    for i in range(4):
        for j in range(i + 1):
            value = covariance[i, j]
            if i == j:
                value = max(value, 0) + params.floors[i] ** 2
            value -= factor[i, :j] @ factor[j, :j]
            factor[i, j] = np.sqrt(max(value, params.floors[i] ** 2 / 4)) if i == j else value / factor[j, j]
    return mean, factor


def _plain_starts(x, params):
    starts = [[] for _ in range(5)]
    for i in range(4):
        unit = params.floors[i] / 4
        bins = np.sort(np.clip(np.floor(x[:, i] / unit), -4000, 4000))
        q = [bins[max(int(np.ceil(len(x) * k / 16)), 1) - 1] for k in range(17)]
        _, low, high = min((q[k + 8] - q[k], q[k], q[k + 8]) for k in range(9))
        starts[0].append(((q[8] + 0.5) * unit, 2 * params.floors[i]))
        for s, (a, b) in enumerate([(q[4], q[12]), (low, high), (q[0], q[8]), (q[8], q[16])], 1):
            starts[s].append(((a + b + 1) / 2 * unit, max((b - a + 1) * unit / 2 / 0.6745, params.floors[i])))
    return [(np.array([m for m, _ in s]), np.diag([d for _, d in s])) for s in starts]


def _plain_estimate(x, params):
    """Every start in memory: two steps, the best two different ones to the fixed point, the least determinant."""
    least = min(len(x), max(len(x) * params.share, (len(x) + 5) // 2))
    size = lambda factor: np.log(np.diag(factor)).sum()

    def step(mean, factor):
        y = np.linalg.solve(factor, (x - mean).T)
        d2 = (y * y).sum(axis=0)
        with np.errstate(divide="ignore"):
            bins = np.where(d2 < 1, np.floor(d2 * 32), 32 + np.minimum(np.floor(32 * np.log2(d2)), 6400))
        return _plain_factor(x[bins <= np.sort(bins)[int(np.ceil(least)) - 1]], params)

    states, done = {s: (start, False) for s, start in enumerate(_plain_starts(x, params))}, {}
    for count in range(1, 100):
        for s, (state, _) in list(states.items()):
            new = step(*state)
            same = np.allclose(new[0], state[0], atol=1e-12) and np.allclose(new[1], state[1], atol=1e-12)
            over = same or count >= params.patience and size(new[1]) >= size(state[1])
            done[s] = new
            states[s] = new, over
        if count == params.trial:
            met = {}  # starts that have met are one
            for s in sorted(done):
                met.setdefault(tuple(np.round(np.concatenate([done[s][0], done[s][1].ravel()]), 9)), s)
            best = sorted(met.values(), key=lambda s: (size(done[s][1]), s))[: params.finalists]
            done = {s: e for s, e in done.items() if s in best or s not in states or states[s][1]}
            states = {s: states[s] for s in states if s in best}
        states = {s: state for s, state in states.items() if not state[1]}
        if not states:
            break
    return min(done.values(), key=lambda e: size(e[1]))


def test_estimate_is_that_of_all_starts(spark):
    """Groups with junk on one or two sides, of correlated and of constant statistics."""
    rng, groups = np.random.default_rng(8), {}
    for g in range(6):
        n = 150 + 70 * g
        x = rng.normal(size=(n, 4)) * [3, 0.8, 0.5, 0.05] + [1, 0.5, 0.3, 0.02]
        x[:, 1] += 0.2 * x[:, 0]
        x[: n // 3] += [[0, 5, 0, 0], [30, 0, 0, 0], [0, 2, 2, 0.4], [0, 0, 0, 0], [-20, 8, 0, 0.5], [4, 1, 0, 0]][g]
        if g == 3:
            x[:, 2] = 0
        groups[f"g{g}"] = np.round(x * UNIT).astype(np.int64)
    rows = [(g, *map(int, row)) for g, x in groups.items() for row in x]
    df = spark.createDataFrame(rows, "`group` string, x0 bigint, x1 bigint, x2 bigint, x3 bigint").repartition(3)
    params = QualityParams()
    found = {r["group"]: r for r in _estimates(df, params).collect()}
    assert set(found) == set(groups)
    for g, x in groups.items():
        mean, factor = _plain_estimate(x / UNIT, params)
        assert found[g]["rows"] == len(x)
        assert np.allclose([found[g][f"m{i}"] for i in range(4)], mean, atol=1e-6), g
        assert np.allclose([found[g][f"l{i}{j}"] for i in range(4) for j in range(i + 1)], [factor[i, j] for i in range(4) for j in range(i + 1)], atol=1e-6), g


def test_small_groups_take_the_estimate_of_their_language(spark):
    """Sources of ten documents among large ones; a long text beside them."""
    rng, rows, junk = random.Random(11), [], {}
    for i in range(600):
        words = ["".join(rng.choice("aeiounst") for _ in range(max(1, round(rng.gauss(5, 2))))) for _ in range(rng.randint(60, 300))]
        junk[i] = i % 20 == 0
        rows.append((i, " ".join(w + "$" * 9 * junk[i] for w in words), "en", f"tiny{i // 10}" if i < 200 else "large", "", 0, ""))
    rows.append((600, " ".join("".join(rng.choice("aeiounst") for _ in range(max(1, round(rng.gauss(5, 2))))) for _ in range(200_000)), "en", "large", "", 0, ""))
    got = {r["doc_id"]: r["kept"] for r in verdicts(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert got == {i: not j for i, j in junk.items()} | {600: True}
