"""Secrets: candidates by patterns, false positives removed by a random forest.

Candidates are private key blocks, keys in published formats, signed web tokens, passwords in addresses, values
assigned to a credential's name, and long strings with a digit. The forest sees a candidate's length, its character
transitions, how much of it dictionary words cover, path features and the words around it. It is trained on labelled
findings; without given ones, findings are labelled by a strict rule: a value assigned to a credential's name is a
secret, digests, numbers, paths, addresses and ordinary words are none, and a bare string has no label. The forest
carries that over to candidates the rule cannot place, and judges anew what the rule holds for none. A finding in a
published format, or one that the rule labels a secret, stays one, however rare its shape is.

Everything is measured over whole values and whole texts.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streakline.llm.common import ORIGINAL, packed, prepare, stored, unpacked

NAMES = r"token|secret|passwo?r?d|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?key|auth|authorization|bearer|credentials?"
ASSIGNED = re.compile(
    rf"(?i)(?:{NAMES})[\"']?\s{{0,4}}(?::=|=>|[:=])\s{{0,4}}(?:(?:bearer|basic|token)\s{{1,4}})?(?P<quote>[\"'`]?)(?P<value>[^\s\"'`,;]{{6,}}+)"
)
LONG = re.compile(r"[A-Za-z0-9+/_=.\-]{16,}+")
#: Published formats of keys. Each match begins where a word begins, so a text is read once per format.
BLOCK = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----(?:[^-]|-(?!----))*+-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----")
KEYS = re.compile(
    r"(?<![A-Za-z0-9_\-])(?:A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{36,}+|github_pat_[A-Za-z0-9_]{22,}+|glpat-[A-Za-z0-9_\-]{20,}+"
    r"|xox[abprs]-[A-Za-z0-9\-]{10,}+|AIza[A-Za-z0-9_\-]{35}(?![A-Za-z0-9_\-])|[sr]k_live_[A-Za-z0-9]{16,}+|npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"
    r"|eyJ[A-Za-z0-9_\-]{8,}+\.eyJ[A-Za-z0-9_\-]{4,}+\.[A-Za-z0-9_\-]{8,}+)"
)
IN_ADDRESS = re.compile(r"(?i)(?<![a-z0-9+.\-])[a-z][a-z0-9+.\-]{1,30}://[^\s/:@\"'<>]*+:(?P<value>[^\s/@\"'<>]{3,}+)@")
PLACEHOLDER = re.compile(r"(?i)example|placeholder|changeme|your[_-]|x{6}|\*{3}|<|\$\{|\{\{")
HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
NAME = re.compile(rf"(?i)(?:{NAMES})")
HARMLESS = re.compile(
    r"(?i)(?<![a-z])(?:examples?(?!\.(?:com|org|net))|samples?|dummy|placeholder|tests?|sha1|sha256|md5|commit|checksum|digest|uuid|hash|revision|etag)(?![a-z])"
)
PATH_WORD = re.compile(r"(?i)test|spec|fixture|mock|example|sample|doc|readme|vendor|lock")
EXTENSION = re.compile(r"\.[A-Za-z]{2,5}$")
LETTERS = re.compile(r"[^\W\d_]{4,}")
LONGEST = 32
OFTEN = 5
DIGESTS = frozenset({32, 40, 56, 64, 96, 128})
AROUND = 48


@dataclass(frozen=True)
class SecretParams:
    """``one_in``: a word that occurs five times or more and is at least one in so many words of all documents is in the
    dictionary, so there are at most ``one_in`` of them, at any size. ``train_rows``: the most labelled findings the forest is fitted on, different
    ones, drawn by hash for each label. ``threshold``: the least probability of a secret."""

    one_in: int = 50_000
    train_rows: int = 20_000
    trees: int = 24
    depth: int = 6
    threshold: float = 0.5
    seed: int = 7


FEATURES = (
    "length", "entropy", "distinct_share", "digit_share", "upper_share", "class_changes", "transition_surprise", "dictionary_cover",
    "slashes", "dots", "extension", "path_word", "url_before", "at_before", "name_before", "assigned", "quoted", "harmless_around", "words_around_known",
    "format", "one_word", "digest",
)
FORMAT = FEATURES.index("format")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                counts.update(w for w in LETTERS.findall(text.lower()) if len(w) <= LONGEST)
        if len(counts) > 500_000:
            yield out(counts)
            counts = Counter()
    yield out(counts)


@dataclass(frozen=True)
class Lexicon:
    """The dictionary's words, and how often one symbol follows another in all words."""

    words: frozenset[str]
    pairs: dict[str, int]


def lexicon(docs: DataFrame, text: str = "text", one_in: int = 50_000) -> Lexicon:
    """Words are whole runs of 4 to 32 letters of all documents, in lower case. At most ``one_in`` words and 27 x 27 pairs
    leave the executors."""
    counted = docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(_count_words, "word string, n bigint")
    totals = stored(counted.groupBy("word").agg(F.sum("n").alias("n")), "word_counts")
    symbols = F.regexp_replace("word", "[^a-z]", "-")
    pairs = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(symbols, i, F.lit(2)))
    found = totals.select(F.explode(pairs).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    every = totals.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    words = totals.where((F.col("n") * one_in >= every) & (F.col("n") >= OFTEN)).select("word").collect()
    return Lexicon(frozenset(r["word"] for r in words), {r["pair"]: r["n"] for r in found})


def _symbol(c: str) -> str:
    return c if "a" <= c <= "z" else "0" if c.isdigit() else "A" if c.isupper() else "-"


class Measures:
    """Features of candidates, given the lexicon."""

    def __init__(self, known: Lexicon):
        self.words = known.words
        # A word's first four letters tell which lengths can match at a place, longest first.
        self._sizes: dict[str, list[int]] = {}
        for word in known.words:
            self._sizes.setdefault(word[:4], []).append(len(word))
        for start, sizes in self._sizes.items():
            self._sizes[start] = sorted(set(sizes), reverse=True)
        firsts: Counter = Counter()
        for (a, _), n in known.pairs.items():
            firsts[a] += n
        self._surprise = {(a, b): math.log2((firsts[a] + 40) / (n + 1)) for (a, b), n in known.pairs.items()}
        self._unseen = {a: math.log2(n + 40) for a, n in firsts.items()}

    def surprise(self, value: str) -> float:
        if len(value) < 2:
            return 0.0
        s = [_symbol(c) for c in value]
        return sum(self._surprise.get(p, self._unseen.get(p[0], 6.0)) for p in zip(s, s[1:], strict=False)) / (len(s) - 1)

    def cover(self, value: str) -> float:
        """The share of the characters inside dictionary words, longest match first from the left."""
        low, covered, i = value.lower(), 0, 0
        while i < len(low):
            for size in self._sizes.get(low[i : i + 4], ()):
                if low[i : i + size] in self.words:
                    covered += size
                    i += size
                    break
            else:
                i += 1
        return covered / len(low)

    def features(self, text: str, begin: int, end: int, path: str | None, known_format: bool = False) -> list[float]:
        value, before, after = text[begin:end], text[max(0, begin - AROUND) : begin], text[end : end + AROUND]
        n, counts = len(value), Counter(value)
        classes = [_symbol(c) if not "a" <= c <= "z" else "a" for c in value]
        near = LETTERS.findall((before + " " + after).lower())
        return [
            float(n),
            -sum(k / n * math.log2(k / n) for k in counts.values()),
            len(counts) / n,
            sum(map(str.isdigit, value)) / n,
            sum(map(str.isupper, value)) / n,
            sum(a != b for a, b in zip(classes, classes[1:], strict=False)) / max(1, n - 1),
            self.surprise(value.lower()),
            self.cover(value),
            value.count("/") / n,
            value.count(".") / n,
            float(bool(EXTENSION.search(value))),
            float(bool(PATH_WORD.search(path or ""))),
            float("://" in before[-12:] or "www." in before[-12:]),
            float("@" in before[-2:]),
            float(bool(NAME.search(before[-24:]))),
            float(bool(re.search(r"[:=>]\s*(?:(?i:bearer|basic|token)\s+)?[\"'`]?$", before))),
            float(bool(before and after and before[-1] in "\"'`" and after[0] == before[-1])),
            float(bool(HARMLESS.search(before) or HARMLESS.search(after))),
            sum(w in self.words for w in near) / max(1, len(near)),
            float(known_format and len(counts) >= 3 and not PLACEHOLDER.search(value)),
            float(value.lower() in self.words),
            float(n in DIGESTS and bool(HEX.fullmatch(value))),
        ]


def spans(text: str) -> list[tuple[int, int, bool]]:
    """Candidates in order, without overlaps, and whether each has a published format. Of overlapping ones a key block
    wins, then a key, a password in an address, an assigned value and a long string, in this order."""
    taken: list[tuple[int, int, bool]] = []
    for pattern, group, known in ((BLOCK, 0, True), (KEYS, 0, True), (IN_ADDRESS, "value", True), (ASSIGNED, "value", False), (LONG, 0, False)):
        begins, found = [t[0] for t in taken], []
        for m in pattern.finditer(text):
            if pattern is LONG and not any(c.isdigit() for c in m[0]):
                continue
            begin, end = m.span(group)
            at = bisect_left(begins, end)
            # Those taken do not overlap, so only the last that begins before the end can reach into it.
            if not at or taken[at - 1][1] <= begin:
                found.append((begin, end, known))
        if found:
            taken = sorted(taken + found)
    return taken


def rule(features: list[float]) -> bool | None:
    """The label of a finding where it is plain, else None."""
    f = dict(zip(FEATURES, features, strict=True))
    if f["format"]:
        return True
    named = f["name_before"] and f["assigned"]
    if named and not f["harmless_around"] and not f["one_word"] and f["entropy"] >= 3 and (f["length"] >= 12 or f["dictionary_cover"] < 0.3):
        return True
    if named and not f["one_word"]:
        return None
    if f["one_word"] or f["digest"] or f["digit_share"] == 1 or f["extension"] or f["slashes"] or f["url_before"] or f["at_before"] or f["harmless_around"]:
        return False
    return False if f["dictionary_cover"] >= 0.5 and not f["name_before"] and not f["quoted"] else None


def _candidates(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measures = Measures(shared.value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.bool_())
        for batch in batches:
            columns = [[] for _ in kinds]
            for doc, row, text, path in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                for begin, end, known in spans(text or ""):
                    features = measures.features(text, begin, end, path, known)
                    for column, value in zip(columns, (doc, row, begin, end, features, rule(features)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "row", "begin", "end", "features", "label"])

    return run


def candidates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str = "source", params: SecretParams | None = None) -> DataFrame:
    """A row per candidate: ``doc_id``, ``row`` (hash of id and text), ``begin`` and ``end`` in code points,
    ``features`` in the order of ``FEATURES``, and the rule's ``label`` or null."""
    params = params or SecretParams()
    spark = docs.sparkSession
    prepare(spark)
    known = spark.sparkContext.broadcast(lexicon(docs, text, params.one_in))
    content = F.col(f"`{text}`").cast("string")
    inputs = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("row"), content.alias("text"), F.col(f"`{path}`").cast("string").alias("path")
    )
    return inputs.mapInArrow(_candidates(known), "doc_id bigint, row bigint, begin bigint, end bigint, features array<double>, label boolean")


def fit(labelled: DataFrame, params: SecretParams | None = None) -> RandomForestClassificationModel | None:
    """A forest on at most ``train_rows`` different rows with ``features`` and ``label``; None unless both labels occur.

    Each label has half of the rows, those of the least hash, and what the other label leaves of its half."""
    params = params or SecretParams()
    rows = labelled.where("label is not null").select("features", F.col("label").cast("double").alias("label")).distinct()
    order = [F.xxhash64("features", "label"), "features"]
    first = [rows.where(F.col("label") == label).orderBy(*order).limit(params.train_rows) for label in (0.0, 1.0)]
    drawn = stored(first[0].unionByName(first[1]).coalesce(1), "labelled_findings")
    n = {r["label"]: r["count"] for r in drawn.groupBy("label").count().collect()}
    if len(n) < 2:
        return None
    half = params.train_rows // 2
    n = {label: min(n[label], max(1, half, params.train_rows - n[1.0 - label])) for label in n}
    taken = [drawn.where(F.col("label") == label).orderBy(*order).limit(n[label]) for label in (0.0, 1.0)]
    sample = taken[0].unionByName(taken[1]).coalesce(1)
    # Each label weighs the same, so a rare one is not lost.
    weight = F.when(F.col("label") == 1.0, sum(n.values()) / (2 * n[1.0])).otherwise(sum(n.values()) / (2 * n[0.0]))
    vectors = sample.select(array_to_vector("features").alias("vector"), "label", weight.alias("weight"))
    forest = RandomForestClassifier(
        featuresCol="vector", labelCol="label", weightCol="weight", numTrees=params.trees, maxDepth=params.depth, seed=params.seed, featureSubsetStrategy="sqrt"
    )
    return forest.fit(vectors)


def find_secrets(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str = "source", labelled: DataFrame | None = None, params: SecretParams | None = None
) -> DataFrame:
    """A row per candidate: ``doc_id``, ``row``, ``begin``, ``end``, ``probability`` and ``secret``.

    ``labelled`` has ``features`` and ``label``; by default the rule's labels of these documents. Where they hold one
    label only, no forest can be fitted and the probability is that label, or 0 without any. A finding in a published
    format that is no placeholder has probability 1, as has one that the rule labels a secret where no labels are given. A null text has no
    candidates; a null path counts as empty; repeated rows have candidates of their own."""
    params = params or SecretParams()
    found = stored(candidates(docs, text, doc_id, path, params), "secret_candidates")
    model = fit(found if labelled is None else labelled, params)
    if model is None:
        scored = found.withColumn("probability", F.coalesce(F.col("label").cast("double"), F.lit(0.0)))
    else:
        scored = model.transform(found.withColumn("vector", array_to_vector("features"))).withColumn("probability", vector_to_array("probability")[1])
    certain = (F.get("features", F.lit(FORMAT)) == 1.0) | (F.coalesce("label", F.lit(False)) & F.lit(labelled is None))
    scored = scored.withColumn("probability", F.when(certain, F.lit(1.0)).otherwise(F.col("probability")))
    return scored.select("doc_id", "row", "begin", "end", F.round("probability", 6).alias("probability")).withColumn("secret", F.col("probability") >= params.threshold)


def redact_secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str = "source", mask: str = "[SECRET]", params: SecretParams | None = None) -> DataFrame:
    """The documents, each secret replaced by ``mask``; everything else, and all rows, stay. Rows meet their secrets by
    id and hash, so texts with the same hash keep their own."""
    found = find_secrets(docs, text, doc_id, path, params=params).where("secret")
    cuts = found.groupBy(F.coalesce("doc_id", F.lit(0)).alias("id"), "row").agg(F.collect_set(F.struct("begin", "end")).alias("cuts"))

    def run(value: pa.Array, cuts: pa.Array) -> pa.Array:
        out = []
        for content, places in zip(value.to_pylist(), cuts.to_pylist(), strict=True):
            for place in sorted(places or [], key=lambda p: -p["begin"]):
                content = content[: place["begin"]] + mask + content[place["end"] :]
            out.append(content)
        return pa.array(out, pa.string())

    masked = F.arrow_udf(run, "string")
    row = F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    key = F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(0)).alias("id")
    own = docs.select(packed(docs), key, row.alias("row")).join(cuts.hint("merge"), ["id", "row"], "left")
    own = own.select(ORIGINAL, F.when(F.col("cuts").isNull(), F.col(ORIGINAL)[text]).otherwise(masked(F.col(ORIGINAL)[text], "cuts")).alias("masked"))
    return unpacked(own, docs.columns, **{text: F.col("masked")}).select(*docs.columns)
