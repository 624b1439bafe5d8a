"""Languages of a text as a mixture, by expectation-maximisation over character n-grams.

Training counts the n-grams of all labelled texts; a task sends each gram of a language once a flush, and the counts
meet by gram. The model keeps the ``grams`` grams that occur most often over all languages, so its size is bounded by
that parameter times the number of languages, whatever the corpus holds.

A text's grams are read as drawn from a mixture of the languages. Expectation-maximisation gives the proportions, once
for all languages and then for the sets of the one, two, ... languages of the largest proportions; the set of greatest
penalised likelihood is selected. Batches of texts are estimated together in array operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streakline.llm.common import ORIGINAL, packed, prepare, unpacked

UNKNOWN = "und"
#: Code points below this share a table; one beyond U+10FFFF does not exist.
POINTS = 0x110000


@dataclass(frozen=True)
class MixtureParams:
    """``grams``: the model keeps that many n-grams at most (ties by gram). ``order``: code points a gram, at most 3.
    ``smoothing`` is added to every count. Overlapping grams are not independent: a gram counts as 1 / ``order`` of an
    observation. ``penalty`` times half the logarithm of the observations is taken off for each further language.
    ``steps`` and ``tolerance`` end the estimation: so many steps, or no proportion that changes by more."""

    grams: int = 100_000
    order: int = 3
    smoothing: float = 0.5
    penalty: float = 3.0
    steps: int = 40
    tolerance: float = 1e-4


@cache
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    table = np.zeros(POINTS, bool)
    for first in range(0, POINTS, 0x10000):
        if first != 0xD0000:
            table[first : first + 0x10000] = [chr(p).isalpha() for p in range(first, min(first + 0x10000, POINTS))]
    return table


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text)) if len(text) < 64 else bool(_letters()[_points(text)].any())


def grams_of(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of all texts and the number of the text of each. Letters in lower case; whatever stands between letters is
    one border, which also starts and ends a text. No gram has a border at its second place (at its only one, if alone)."""
    points = [_points(t) for t in texts]
    sizes = np.array([len(p) + 1 for p in points], np.int64)
    flat = np.zeros(int(sizes.sum()) + 1, np.uint32)
    owner = np.repeat(np.arange(len(texts)), sizes)
    at = 1
    for p in points:
        flat[at : at + len(p)] = p
        at += len(p) + 1
    letter = _letters()[flat]
    keep = letter | np.concatenate([[True], letter[:-1]])  # of a stretch without letters, the first place
    point = np.where(letter, flat, 0)[keep].astype(np.int64)
    of = np.concatenate([[0], owner])[keep]
    if len(point) < order:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gram = point[: len(point) - order + 1].copy()
    for k in range(1, order):
        gram = gram << 21 | point[k : len(point) - order + 1 + k]
    inner = point[1 : len(point) - order + 2] if order > 1 else point
    whole = inner > 0 if order > 1 else point > 0
    # Between two texts lies a border, so no gram that is counted spans both.
    return gram[whole], of[1 : len(of) - order + 2][whole] if order > 1 else of[whole]


def _texts(batch: pa.RecordBatch) -> list[str]:
    """Texts as they are in UTF-8; bytes that are none become U+FFFD."""
    return [(t or b"").decode("utf-8", "replace") for t in batch.column("text").to_pylist()]


def _counted(batches: Iterator[pa.RecordBatch], order: int, flush: int) -> Iterator[pa.RecordBatch]:
    """Counts of (lang, gram), added up within the task until ``flush`` of them are held."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, (gram, n) in held.items():
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(gram)), pa.array(gram), pa.array(n)], names=["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        texts, langs = _texts(batch), np.array(batch.column("lang").to_pylist(), object)
        for lang in dict.fromkeys(langs):
            gram, n = np.unique(grams_of([texts[i] for i in np.flatnonzero(langs == lang)], order)[0], return_counts=True)
            if lang in held:
                old = held[lang]
                gram, place = np.unique(np.concatenate([old[0], gram]), return_inverse=True)
                n = np.bincount(place, np.concatenate([old[1], n])).astype(np.int64)
            held[lang] = gram, n
        if sum(len(g) for g, _ in held.values()) >= flush:
            yield from out()
    yield from out()


@dataclass(frozen=True)
class LanguageModel:
    """``langs`` in order; ``grams`` sorted; ``logp`` the logarithm of each gram's likelihood in each language, the last
    row that of any other gram; ``common`` the language of most grams."""

    langs: tuple[str, ...]
    grams: np.ndarray
    logp: np.ndarray
    common: int
    order: int


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", params: MixtureParams | None = None) -> LanguageModel:
    """The model of all rows whose text and language are not null. No such rows give a model without languages."""
    params = params or MixtureParams()
    if not 1 <= params.order <= 3:
        raise ValueError("order is 1, 2 or 3")
    prepare(docs.sparkSession)
    order = params.order
    rows = docs.select(F.col(f"`{text}`").cast("binary").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = rows.mapInArrow(lambda batches: _counted(batches, order, 1 << 20), "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by_gram = counts.groupBy("gram").agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("of"))
    # At most ``grams`` rows, with an entry per language.
    top = by_gram.orderBy(F.desc("total"), "gram").limit(params.grams).select("gram", F.explode("of").alias("of")).select("gram", "of.lang", "of.n").toArrow()
    langs, lang_of = np.unique(top.column("lang").to_numpy().astype(str), return_inverse=True)
    grams, row_of = np.unique(top.column("gram").to_numpy(), return_inverse=True)
    n = np.zeros((len(grams) + 1, len(langs)))
    n[row_of, lang_of] = top.column("n").to_numpy()
    common = int(n.sum(axis=0).argmax()) if len(langs) else 0
    n += params.smoothing
    return LanguageModel(tuple(map(str, langs)), grams.astype(np.int64), np.log(n / n.sum(axis=0)) if len(langs) else n, common, order)


def _mixed(p: np.ndarray, weight: np.ndarray, first: np.ndarray, of: np.ndarray, size: np.ndarray, pi: np.ndarray, params: MixtureParams) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log likelihood of each text, from the proportions ``pi``. A proportion of zero stays zero. A text's
    estimate ends by itself, whatever texts are beside it."""
    active = np.ones(len(pi), bool)
    for _ in range(params.steps):
        joint = p * pi[of]
        mass = joint.sum(axis=1)
        new = np.add.reduceat(joint * (weight / mass)[:, None], first) / size[:, None]
        moved = np.abs(new - pi).max(axis=1)
        pi = np.where(active[:, None], new, pi)
        active &= moved >= params.tolerance
        if not active.any():
            break
    return pi, np.add.reduceat(weight * np.log((p * pi[of]).sum(axis=1)), first)


def mixtures(texts: list[str], model: LanguageModel, params: MixtureParams) -> np.ndarray:
    """Proportions of the selected languages of each text; zeros for a text without a gram of the model."""
    n, k = len(texts), len(model.langs)
    result = np.zeros((n, k))
    gram, owner = grams_of(texts, model.order)
    at = np.searchsorted(model.grams, gram)
    known = (at < len(model.grams)) & (model.grams[np.minimum(at, len(model.grams) - 1)] == gram)
    # Grams that the model does not have say nothing about the language.
    key, times = np.unique(owner[known] * (len(model.grams) + 1) + at[known], return_counts=True)
    if not len(key):
        return result
    text, row = np.divmod(key, len(model.grams) + 1)
    present, first, of = np.unique(text, return_index=True, return_inverse=True)
    weight = times / model.order
    logp = model.logp[row]
    top = logp.max(axis=1)
    p = np.exp(logp - top[:, None])
    size = np.add.reduceat(weight, first)
    whole, _ = _mixed(p, weight, first, of, size, np.full((len(present), k), 1 / k), params)
    rank = np.argsort(np.argsort(-whole, axis=1, kind="stable"), axis=1)
    fee = params.penalty * 0.5 * np.log1p(size)
    best, chosen, going = np.full(len(present), -np.inf), np.zeros((len(present), k)), np.ones(len(present), bool)
    for languages in range(1, k + 1):
        if languages == 1:
            # The single language of greatest likelihood, which need not be the one of the largest proportion.
            alone = np.add.reduceat(weight[:, None] * np.log(p), first)
            pi, like = np.eye(k)[alone.argmax(axis=1)], alone.max(axis=1)
        else:
            start = np.where(rank < languages, np.maximum(whole, 1e-6), 0.0)
            pi, like = _mixed(p, weight, first, of, size, start / start.sum(axis=1, keepdims=True), params)
        value = like - fee * (languages - 1)
        going &= value > best
        best[going], chosen[going] = value[going], pi[going]
        if not going.any():
            break
    result[present] = chosen
    return result


def _predicted(batches: Iterator[pa.RecordBatch], model: LanguageModel, params: MixtureParams) -> Iterator[pa.RecordBatch]:
    kinds = pa.list_(pa.struct([("lang", pa.string()), ("proportion", pa.float64())]))
    for batch in batches:
        texts = _texts(batch)
        shares = mixtures(texts, model, params) if model.langs else np.zeros((len(texts), 0))
        langs, scores, sets = [], [], []
        for text, share in zip(texts, shares, strict=True):
            if share.any():
                i = int(share.argmax())
                langs.append(model.langs[i])
                scores.append(min(1.0, float(share[i])))
                sets.append([{"lang": model.langs[j], "proportion": float(share[j])} for j in np.argsort(-share, kind="stable") if share[j] > 0])
            else:  # no letter, or none of the model's grams
                guess = bool(model.langs) and has_letter(text)
                langs.append(model.langs[model.common] if guess else UNKNOWN)
                scores.append(1 / len(model.langs) if guess else 0.0)
                sets.append([])
        yield pa.RecordBatch.from_arrays([batch.column(ORIGINAL), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, kinds)], names=[ORIGINAL, "lang_pred", "score", "languages"])


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", params: MixtureParams | None = None, keep: list[str] | None = None) -> DataFrame:
    """The documents' columns (those of ``keep``, if given), ``lang_pred``, its proportion ``score`` and ``languages``, the
    selected set with proportions.

    A null text, one without a letter, or a model without languages gives ``und``, 0 and no set. A text with letters but
    none of the model's grams gets the language of most grams, with 1 / languages. Equal texts get equal results; ties go
    to the language first in order. Columns of the same names are replaced.
    """
    params = params or MixtureParams()
    spark = docs.sparkSession
    prepare(spark)
    columns = docs.columns if keep is None else keep
    rows = docs.select(packed(docs.select(*[F.col(f"`{c}`") for c in columns])), F.col(f"`{text}`").cast("binary").alias("text"))
    shared = spark.sparkContext.broadcast(model)
    original = rows.schema[ORIGINAL].dataType.simpleString()
    out = f"{ORIGINAL} {original}, lang_pred string, score double, languages array<struct<lang: string, proportion: double>>"
    found = rows.mapInArrow(lambda batches: _predicted(batches, shared.value, params), out)
    return unpacked(found, columns, lang_pred=F.col("lang_pred"), score=F.col("score"), languages=F.col("languages"))


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """Whether the crc32 of the id as text leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", params: MixtureParams | None = None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``languages`` of every row; learnt from the text and language
    of the rows that are not held out."""
    params = params or MixtureParams()
    out = held_out(F.col(f"`{doc_id}`"))
    model = learn(docs.where(~out), text, lang, params)
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), out.alias("held_out"), F.col(f"`{text}`").alias("text"))
    return predict(slim, model, params=params, keep=["doc_id", "held_out"])
