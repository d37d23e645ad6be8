"""Language of texts as a mixture: proportions by expectation-maximisation.

A language is a distribution over byte trigrams of lower-case letters, counted over all
texts of that language. A document is a mixture of languages: for a set of languages,
expectation-maximisation finds the proportions under which its trigrams are likeliest.
The set grows from the likeliest single language, by the next largest proportion, as long
as the log likelihood gains more than a penalty that grows with the document's length.

The model holds a quarter of a megabyte a language, on the driver and in each worker. A
column with more than `MOST_LANGUAGES` values is no column of languages, and `train` refuses
it by name before it counts anything; nothing is left out silently.

Defined results: `und` with score 0 where the text is null or has no letter, and
everywhere when no text teaches. Ties go to the first language by name. Whole texts count,
whatever their length; repeated rows and extra columns change nothing but the counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = 1 << 15
ITERATIONS = 15
SMOOTHING = 0.1  # added to each count
PENALTY = 4.0  # per language more, times the logarithm of the number of trigrams
UNKNOWN = "und"
MOST_LANGUAGES = 512

# ASCII characters that aren't letters become spaces; bytes above stay as they are.
_LETTERS = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def trigram_counts(text: str) -> np.ndarray:
    """How often each cell occurs in a text."""
    data = np.frombuffer(b" " + text.lower().encode().translate(_LETTERS) + b" ", np.uint8)
    data = data.astype(np.uint32)
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    code = code[(data[1:-1] != 32) | (data[:-2] != 32) & (data[2:] != 32)]
    return np.bincount((code * np.uint32(2654435761)) >> np.uint32(17), minlength=CELLS)


def proportions(likelihood: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Mixture of the columns' languages that fits best, and its log likelihood."""
    languages = likelihood.shape[1]
    share = np.full(languages, 1.0 / languages)
    total = counts.sum()
    if languages > 1:
        for _ in range(ITERATIONS):
            mixed = likelihood @ share
            share = share * ((counts / mixed) @ likelihood) / total
    return share, float(counts @ np.log(likelihood @ share))


def language_mixture(text: str | None, likelihood: np.ndarray) -> dict[int, float]:
    """Proportions of the languages chosen for a text; empty if it has no letter."""
    if not text or not likelihood.shape[1] or not any(map(str.isalpha, text)):
        return {}
    every = trigram_counts(text)
    cells = np.flatnonzero(every)
    counts, local = every[cells].astype(float), likelihood[cells]
    if not len(cells):
        return {}
    single = counts @ np.log(local)
    chosen = [int(np.argmax(single))]
    share, best = np.ones(1), float(single[chosen[0]])
    if local.shape[1] > 1:
        penalty = PENALTY * np.log1p(counts.sum())
        overall, _ = proportions(local, counts)
        for language in np.argsort(-overall, kind="stable"):
            if language in chosen:
                continue
            wider, gained = proportions(local[:, [*chosen, language]], counts)
            if gained - best <= penalty:
                break
            chosen.append(int(language))
            share, best = wider, gained
    return dict(zip(chosen, share.tolist()))


def train(
    documents: DataFrame, text: str = "text", lang: str = "lang"
) -> tuple[list[str], np.ndarray]:
    """Languages by name, and the probability of each cell in each of them.

    Every task counts its own texts; the counts are added up by Spark, so what reaches the
    driver is bounded by the number of languages, which is checked first.
    """
    rows = documents.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    found = rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).count()
    if found > MOST_LANGUAGES:
        raise ValueError(f"column {lang} has more than {MOST_LANGUAGES} values: not languages")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, value in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                if name not in totals:
                    totals[name] = np.zeros(CELLS, np.int64)
                totals[name] += trigram_counts(value)
        for name, total in totals.items():
            cells = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(cells), pa.string()),
                    pa.array(cells, pa.int32()),
                    pa.array(total[cells], pa.int64()),
                ],
                names=["lang", "cell", "n"],
            )

    counted = rows.mapInArrow(count, "lang string, cell int, n long")
    found = counted.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    names = found["lang"].to_pylist()
    languages = sorted(set(names))
    counts = np.full((CELLS, len(languages)), SMOOTHING)
    place = {name: i for i, name in enumerate(languages)}
    counts[found["cell"].to_numpy(), [place[n] for n in names]] += found["n"].to_numpy()
    return languages, counts / counts.sum(axis=0, keepdims=True)


def identify(
    documents: DataFrame,
    languages: list[str],
    likelihood: np.ndarray,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, lang_pred, score (its proportion) and languages, all chosen ones' proportions."""
    shared = documents.sparkSession.sparkContext.broadcast(likelihood)
    kind = documents.schema[doc_id].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mixtures = [language_mixture(t, shared.value) for t in batch["text"].to_pylist()]
            named = [{languages[i]: p for i, p in m.items()} for m in mixtures]
            best = [max(sorted(m), key=m.get) if m else UNKNOWN for m in named]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(best, pa.string()),
                    pa.array([min(1.0, m.get(b, 0.0)) for m, b in zip(named, best)], pa.float64()),
                    pa.array([list(m.items()) for m in named], pa.map_(pa.string(), pa.float64())),
                ],
                names=["doc_id", "lang_pred", "score", "languages"],
            )

    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {kind}, lang_pred string, score double, languages map<string,double>"
    return rows.mapInArrow(run, schema)
