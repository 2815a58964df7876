"""Quality rules: robust multivariate outliers per language and source.

Statistics of every whole text become a transformed vector; the location and
scatter of each (language, source) group is a minimum-covariance-determinant
estimate, and vectors with a large Mahalanobis distance are rejected.

The estimate runs as distributed concentration steps: one aggregation gives
the moments of every (group, start, distance bucket), and each group's buckets
(a bounded number) are cut at half its rows. No group is gathered in a task.
Languages and the whole table are estimated in the same way. A group's centre
and scatter are drawn towards its language's, and those towards the whole
table's, with a weight that falls smoothly with the rows.

Defined cases: a null text has no words and fails the base rules; null
language or source is a group of its own; an empty table gives an empty
result; repeated rows are judged one by one, alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import text as X
from tidemark.llm.tables import discard, lean, stored

#: Characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Rows at which a group's own estimate and that of its language count alike.
PRIOR_ROWS = 50
STEPS = 5

#: Vector entries, and the standard deviation added to each: the noise of one
#: measurement, as statistics that are zero in most texts have no scatter of
#: their own. Counting 20 words varies by 0.22 in the logarithm; one repeated
#: passage covers 16 words, 0.05 of a text of 320; one doubled word is 0.69 in
#: the logarithm of a run. An entry of a group without scatter rejects alone at
#: 5.75 times its floor, which each of them can reach.
VECTOR = {
    "log_words": 0.25,
    "log_word_length": 0.14,
    "symbol_rate": 0.33,
    "dup_line_rate": 0.48,
    "repeat_rate": 0.05,
    "log_run": 0.35,
}
P = len(VECTOR)
_FLOOR = np.diag(np.square(list(VECTOR.values())))
#: Consistency factor of the half sample in six dimensions, and the squared
#: distance that a normal vector exceeds once in 100,000.
CONSISTENCY = 1.784
CUTOFF = 33.11

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_run")
_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
_is_symbol = np.zeros(256, bool)
_is_symbol[list(SYMBOLS)] = True


def text_statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base statistics of each row of a slice of texts."""
    words = X.Words(data, offsets)
    rows = len(offsets) - 1
    chars = X.per_row(words.solid & ((data & 0xC0) != 0x80), offsets)
    symbols = X.per_row(_is_symbol[data], offsets)

    # Lines: spans between line feeds within a row; those with a word count.
    spans = X.SpanHash(data)
    feeds = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((offsets[:-1], feeds + 1)))
    ends = np.sort(np.concatenate((offsets[1:], feeds)))
    solid = np.zeros(len(data) + 1, np.int64)
    np.cumsum(words.solid, out=solid[1:])
    some = solid[np.maximum(ends, starts)] > solid[starts]
    starts, ends = starts[some], ends[some]
    doc = np.searchsorted(offsets, starts, "right") - 1
    line = spans(starts, ends)
    order = np.lexsort((line, doc))
    again = np.zeros(len(order), bool)
    if len(order):
        line, of = line[order], doc[order]
        again[1:] = (line[1:] == line[:-1]) & (of[1:] == of[:-1])
    lines = np.bincount(doc, minlength=rows)
    dup = np.bincount(doc[order], weights=again, minlength=rows).astype(np.int64)

    hashes = spans(words.starts, words.ends)
    window = X.runs(hashes, WINDOW)
    whole = words.doc[:len(window)] == words.doc[WINDOW - 1:] if len(window) else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    at = at[X.repeated(X.mix(window[at] + X.mix(words.doc[at].astype(np.uint64))))]
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    covered = np.cumsum(cover)[:len(hashes)] > 0
    repeats = np.bincount(words.doc[covered], minlength=rows)

    # Runs of one word: the longest of each text.
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (words.doc[1:len(hashes)] != words.doc[:len(hashes) - 1])
    first = np.flatnonzero(new)
    run = np.zeros(rows, np.int64)
    np.maximum.at(run, words.doc[first], np.diff(first, append=len(hashes)))
    return dict(zip(STATISTICS, (words.counts, chars, symbols, dup, repeats, lines, run), strict=True))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = X.text_bytes(batch.column("text"))
        for i, j in X.slices(offsets):
            found = text_statistics(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").slice(i, j - i), batch.column("key").slice(i, j - i),
                 *(pa.array(v.astype(np.int64)) for v in found.values())],
                names=["row", "key", *found])


def statistics(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``row`` (the carried columns), ``key``, the statistics and ``base_failed``."""
    source = docs.select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in carry)).alias("row"),
                         F.concat_ws("\n", F.to_json(F.struct("lang")), F.to_json(F.struct("lang", "source"))).alias("key"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([source.schema["row"], T.StructField("key", T.StringType())]
                          + [T.StructField(s, T.LongType()) for s in STATISTICS])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    n = F.greatest(F.col("n_words"), F.lit(1))
    values = (F.log(n), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), F.log(1 + 20 * F.col("n_symbols") / n),
              F.log(1 + 20 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))), F.col("n_repeat_words") / n,
              F.log(F.greatest(F.col("n_run"), F.lit(1))))
    return (source.mapInArrow(lean(_measure), schema).withColumn("base_failed", failed)
            .withColumns({f"x{k}": v for k, v in enumerate(values)}))


def _moments() -> list[Column]:
    return ([F.count(F.lit(1)).alias("n")] + [F.sum(f"x{i}").alias(f"s{i}") for i in range(P)]
            + [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in _PAIRS])


_FIT = ", ".join(["key string", "start int", "logdet double", "n double"] + [f"m{i} double" for i in range(P)]
                 + [f"p{i}{j} double" for i, j in _PAIRS])


def _estimate(key: str, start: int, rows: float, n: float, s: np.ndarray, q: np.ndarray, factor: float) -> dict:
    """Centre and precision of one group of ``rows`` from the summed moments of ``n`` of them."""
    centre = s / n
    scatter = np.zeros((P, P))
    for (i, j), v in zip(_PAIRS, q, strict=True):
        scatter[i, j] = scatter[j, i] = v / n - centre[i] * centre[j]
    scatter = factor * scatter + _FLOOR
    precision = np.linalg.inv(scatter)
    return ({"key": key, "start": start, "logdet": np.linalg.slogdet(scatter)[1], "n": float(rows)}
            | {f"m{i}": centre[i] for i in range(P)} | {f"p{i}{j}": precision[i, j] for i, j in _PAIRS})


def _concentrate(buckets: pd.DataFrame) -> pd.DataFrame:
    """One group and start: keep the nearest buckets up to half the rows."""
    buckets = buckets.sort_values("bucket")
    total = buckets["n"].cumsum().to_numpy()
    inner = buckets.iloc[:int(np.searchsorted(total, (total[-1] + P + 1) // 2)) + 1]
    sums = inner.sum(numeric_only=True)
    return pd.DataFrame([_estimate(buckets["key"].iloc[0], int(buckets["start"].iloc[0]), total[-1], sums["n"],
                                   sums[[f"s{i}" for i in range(P)]].to_numpy(float),
                                   sums[[f"q{i}{j}" for i, j in _PAIRS]].to_numpy(float), CONSISTENCY)])


def _first(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Start 0: medians and median deviations; start 1: mean and covariance."""
    for frame in groups:
        out = []
        for _, g in frame.iterrows():
            out.append(_estimate(g["key"], 1, g["n"], g["n"], g[[f"s{i}" for i in range(P)]].to_numpy(float),
                                 g[[f"q{i}{j}" for i, j in _PAIRS]].to_numpy(float), 1.0))
            spread = np.array([(1.4826 * (g[f"hi{i}"] - g[f"lo{i}"]) / 2) ** 2 for i in range(P)]) + np.diag(_FLOOR)
            out.append({"key": g["key"], "start": 0, "logdet": float(np.log(spread).sum()), "n": float(g["n"])}
                       | {f"m{i}": g[f"mid{i}"] for i in range(P)}
                       | {f"p{i}{j}": 1 / spread[i] if i == j else 0.0 for i, j in _PAIRS})
        if out:
            yield pd.DataFrame(out)


def _distance() -> Column:
    d = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(P)]
    return sum((F.lit(1.0 if i == j else 2.0) * F.col(f"p{i}{j}") * d[i] * d[j] for i, j in _PAIRS), F.lit(0.0))


def _language() -> Column:
    return F.substring_index("key", "\n", 1)


def _with_params(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Rows and their key's estimates. Languages and the whole table are few keys of many rows: those rows stay in place."""
    grouped = F.col("key").contains("\n")
    return (rows.where(grouped).join(params.where(grouped), "key")
            .unionByName(rows.where(~grouped).join(F.broadcast(params.where(~grouped)), "key")))


def fit(measured: DataFrame) -> DataFrame:
    """Best estimate of each group, each language and (key "") all rows: one row per ``key``."""
    rows = measured.where("not base_failed").select(F.explode(F.array("key", _language(), F.lit(""))).alias("key"), *(f"x{i}" for i in range(P)))
    at = lambda i, q: F.percentile(F.round(F.col(f"x{i}"), 3), F.lit(q))  # noqa: E731  rounded: few distinct values
    spread = [e for i in range(P) for e in (at(i, 0.5).alias(f"mid{i}"), at(i, 0.25).alias(f"lo{i}"), at(i, 0.75).alias(f"hi{i}"))]
    params = stored(rows.groupBy("key").agg(*_moments(), *spread).mapInPandas(_first, _FIT), "mcd")
    for _ in range(STEPS):
        bucket = F.least(F.greatest(F.floor(16 * F.log2(_distance() + F.lit(2.0 ** -20))), F.lit(-320)), F.lit(960))
        near = (_with_params(rows, params).withColumn("bucket", bucket.cast("int"))
                .groupBy("key", "start", "bucket").agg(*_moments()))
        last, params = params, stored(near.groupBy("key", "start").applyInPandas(_concentrate, _FIT), "mcd")
        discard(last)
    best = params.groupBy("key").agg(F.min(F.struct("logdet", *params.columns[1:2], *params.columns[3:])).alias("b"))
    return best.select("key", "b.*")


def _shrink(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Groups with their language's (``l_``) and the whole table's (``a_``) estimates: weighted means of centre and scatter."""
    def moments(g, level: str) -> tuple[np.ndarray, np.ndarray]:
        precision = np.zeros((P, P))
        for i, j in _PAIRS:
            precision[i, j] = precision[j, i] = g[f"{level}p{i}{j}"]
        return np.array([g[f"{level}m{i}"] for i in range(P)], float), np.linalg.inv(precision)

    for frame in frames:
        out = []
        for _, g in frame.iterrows():
            centre, scatter = moments(g, "a_")
            for level in ("l_", ""):
                own, weight = moments(g, level), g[f"{level}n"] / (g[f"{level}n"] + PRIOR_ROWS)
                centre, scatter = centre + weight * (own[0] - centre), scatter + weight * (own[1] - scatter)
            precision = np.linalg.inv(scatter)
            out.append({"key": g["key"]} | {f"m{i}": centre[i] for i in range(P)} | {f"p{i}{j}": precision[i, j] for i, j in _PAIRS})
        if out:
            yield pd.DataFrame(out)


def shrunk(fitted: DataFrame) -> DataFrame:
    """Estimate of each group, drawn towards its language's and the whole table's: one row per group's ``key``."""
    level = lambda name: fitted.select(*(F.col(c).alias(f"{name}{c}") for c in fitted.columns))
    groups = fitted.where(F.col("key").contains("\n"))
    wide = groups.join(level("l_"), _language() == F.col("l_key")).crossJoin(F.broadcast(level("a_").where("a_key = ''")))
    schema = ", ".join(["key string"] + [f"m{i} double" for i in range(P)] + [f"p{i}{j} double" for i, j in _PAIRS])
    return wide.mapInPandas(_shrink, schema)


def quality_outliers(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``row`` (the carried columns of each document), its statistics and ``kept``.

    Where texts are carried, their statistics are measured a second time
    instead of being stored and shuffled with them.
    """
    light = [c for c in carry if c != "text"]
    measured = stored(statistics(docs, light), "statistics")
    # One row per group, read from files: Spark broadcasts it if these are small.
    fitted = stored(shrunk(stored(fit(measured), "groups")), "estimates")
    if light != carry:
        discard(measured)
        measured = statistics(docs, carry)
    judged = measured.join(fitted, "key", "left")
    kept = ~F.col("base_failed") & F.coalesce(_distance() <= CUTOFF, F.lit(True))
    return judged.withColumn("kept", kept).select("row", *STATISTICS, "base_failed", "kept")


def keep_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    return quality_outliers(docs, docs.columns).where("kept").select(*(F.col("row")[c].alias(c) for c in docs.columns))
