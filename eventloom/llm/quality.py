"""Quality rules as weak supervision: rules vote or abstain, EM finds their accuracies, posteriors decide."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .flat import (
    SPACE_WORDS,
    Hasher,
    U64,
    byte_class,
    bounds,
    covered,
    first_seen,
    mix,
    per_text,
    repeated,
    row_slices,
    slices,
    text_buffer,
    whole_rows,
    windows,
    words,
)

WINDOW = 8
# A text on which no rule votes has a posterior near one half and stays.
THRESHOLD = 0.3
_SYMBOLS = byte_class(b"#*$%&|<>")
_LETTERS = byte_class([b for b in range(256) if b >= 0x80 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A])
_UPPER = byte_class(range(0x41, 0x5B))
_LOWER = byte_class(range(0x61, 0x7B))

# Common function words of English, French, German and Spanish.
FUNCTION_WORDS = (
    "the of and to in a is that for it on was with as by at from this be are or an not "
    "le la les de des du et un une que qui en est pour dans par sur au avec "
    "der die das und zu den von mit ist im dem nicht ein eine auf sich "
    "el los las y del se por con para es lo su al como"
).split()

STATS = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in (
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "n_lines",
            "n_letter_words",
            "n_distinct_words",
            "n_upper",
            "n_lower",
            "n_wide",
            "n_function_words",
        )
    ]
)


def function_word_prints() -> np.ndarray:
    """Sorted fingerprints of the function words, as written and with a capital."""
    both = [*FUNCTION_WORDS, *(w.capitalize() for w in FUNCTION_WORDS)]
    data = np.frombuffer(" ".join(both).encode(), np.uint8)
    starts, ends, _ = words(data, np.array([0, len(data)]), SPACE_WORDS)
    hasher = Hasher(3)
    return np.unique(hasher.ranges(hasher.prefixes(data), starts, ends))


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of ``STATS`` for every text of an array; a null counts as empty.

    Words are runs without white space; lines are what \\n separates; a line counts as repeated when it has a
    word and equals an earlier line of the text; repeated words lie in an 8-word window found twice or more.
    """
    data, offsets = text_buffer(texts)
    n = len(offsets) - 1
    hasher = Hasher(3)
    starts, ends, owner = words(data, offsets, SPACE_WORDS)
    sums = hasher.prefixes(data)
    hashes = hasher.ranges(sums, starts, ends)
    per_owner = bounds(owner, n)
    in_word = SPACE_WORDS[data]
    out = {"n_words": np.diff(per_owner)}
    out["word_chars"] = per_text(in_word & ((data & 0xC0) != 0x80), offsets)
    out["n_symbols"] = per_text(_SYMBOLS[data], offsets)
    out["n_upper"] = per_text(_UPPER[data], offsets)
    out["n_lower"] = per_text(_LOWER[data], offsets)
    out["n_wide"] = per_text(data >= 0xC0, offsets)  # characters beyond ASCII, by their first byte
    known = function_word_prints()
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    out["n_function_words"] = per_text(known[at] == hashes, per_owner)
    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_LETTERS[data], out=letters[1:])
    out["n_letter_words"] = per_text(letters[ends] > letters[starts], per_owner)

    salt = mix(np.arange(n, dtype=U64) + U64(1))
    first, prints = windows(hashes, owner, WINDOW)
    again = first[repeated(prints ^ salt[owner[first]])]
    out["n_repeat_words"] = per_text(covered(again, WINDOW, len(starts)), per_owner)
    out["n_distinct_words"] = per_text(first_seen(hashes ^ salt[owner]), per_owner)

    breaks = np.flatnonzero(data == 0x0A)
    line_starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    line_ends = np.sort(np.concatenate([offsets[1:], breaks]))
    inside = np.zeros(len(data) + 1, np.int64)
    np.cumsum(in_word, out=inside[1:])
    full = inside[line_ends] > inside[line_starts]
    line_starts, line_ends = line_starts[full], line_ends[full]
    line_owner = np.searchsorted(offsets[1:], line_starts, "right")
    fresh = first_seen(hasher.ranges(sums, line_starts, line_ends) ^ salt[line_owner])
    per_line = bounds(line_owner, n)
    out["n_lines"] = np.diff(per_line)
    out["n_dup_lines"] = per_text(~fresh, per_line)
    return out


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _against(bad: Column) -> Column:
    """-1 where the rule speaks against the text, else it abstains."""
    return F.when(bad, F.lit(-1)).otherwise(F.lit(0)).cast("tinyint")


def _for(good: Column, bad: Column | None = None) -> Column:
    vote = F.when(good, F.lit(1))
    return (vote if bad is None else vote.when(bad, F.lit(-1))).otherwise(F.lit(0)).cast("tinyint")


def rules() -> dict[str, Column]:
    """The voting rules over the columns of ``STATS``. Most know one kind of junk and abstain on all else; a
    few speak for a text."""
    n = F.col("n_words")
    length = _share("word_chars", "n_words")
    symbols = _share("n_symbols", "n_words")
    letters = _share("n_letter_words", "n_words")
    common = _share("n_function_words", "n_words")
    # other scripts have no ASCII case, and none of the function words that are known
    other = F.col("n_wide") > F.col("n_upper") + F.col("n_lower")
    return {
        "word_length": _against((n > 0) & ~length.between(2.5, 14.0)),
        "symbols": _against(symbols > 0.1),
        "dup_lines": _against(_share("n_dup_lines", "n_lines") > 0.3),
        "repeats": _against(_share("n_repeat_words", "n_words") > 0.25),
        "letters": _against((n > 0) & (letters < 0.7)),
        "distinct": _against((n >= 20) & (_share("n_distinct_words", "n_words") < F.when(n < 200, 0.3).otherwise(0.05))),
        "shouting": _against(F.col("n_upper") > F.col("n_lower")),
        "length": _for(n >= 50, n < 20),
        "prose": _for((n > 0) & (letters > 0.9) & (symbols < 0.02) & (other | (F.col("n_upper") * 4 < F.col("n_lower")))),
        "function_words": _for(common >= 0.08, (n >= 50) & (common < 0.01) & ~other),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


class LabelModel:
    """Two classes, rules independent given the class: P(class) and, by class and rule, P(vote)."""

    def __init__(self, names: list[str], prior: float, tables: np.ndarray):
        self.names, self.prior, self.tables = names, prior, tables

    def accuracies(self) -> dict[str, float]:
        """Probability that a vote of the rule, when it votes, names the right class."""
        weight = np.array([1 - self.prior, self.prior])
        right = weight[0] * self.tables[0, :, 0] + weight[1] * self.tables[1, :, 2]
        cast = (weight[:, None] * (self.tables[:, :, 0] + self.tables[:, :, 2])).sum(0)
        return dict(zip(self.names, (right / np.maximum(cast, 1e-12)).tolist()))

    def posterior(self, votes: Mapping[str, Column]) -> Column:
        """P(good | votes), as a column of sums of log odds."""
        odds = F.lit(float(np.log(self.prior) - np.log1p(-self.prior)))
        weights = np.log(self.tables[1]) - np.log(self.tables[0])
        for j, name in enumerate(self.names):
            bad, none, good = (F.lit(float(w)) for w in weights[j])
            odds = odds + F.when(votes[name] < 0, bad).when(votes[name] > 0, good).otherwise(none)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, names: list[str], tolerance: float = 1e-9) -> LabelModel:
    """EM over distinct vote patterns (rows of -1, 0, 1) weighted by how many rows have each.

    It starts from the rows that no rule speaks against. Every table keeps a Dirichlet prior that believes a vote names its
    class more often than not, so the classes cannot change places; it weighs as much as 1 % of the rows.
    An abstention has a probability of its own in each class. No rows: the prior.
    """
    m = len(names)
    counts = np.asarray(counts, np.float64)
    total = counts.sum()
    believed = np.empty((2, m, 3))
    believed[0], believed[1] = [0.3, 0.6, 0.1], [0.02, 0.38, 0.6]
    strength = max(0.01 * total, 1.0)
    if not total:
        return LabelModel(names, 0.5, believed)
    patterns = np.asarray(patterns, np.int64).reshape(-1, m)
    hot = np.stack([patterns == v for v in (-1, 0, 1)], 2).astype(np.float64)
    good = np.where((patterns < 0).any(1), 0.1, 0.9)
    before = -np.inf
    for _ in range(10_000):
        weight = np.stack([counts * (1 - good), counts * good])
        prior = (weight[1].sum() + 0.5 * strength) / (total + strength)
        tables = np.einsum("ci,ijv->cjv", weight, hot) + strength * believed
        tables /= tables.sum(2, keepdims=True)
        logs = np.einsum("ijv,cjv->ci", hot, np.log(tables)) + np.log([[1 - prior], [prior]])
        top = logs.max(0)
        like = top + np.log(np.exp(logs - top).sum(0))
        good = np.exp(logs[1] - like)
        # The objective of EM with priors never falls; it has settled once it stops rising.
        objective = (counts * like).sum() + strength * (believed * np.log(tables)).sum() + 0.5 * strength * np.log(prior * (1 - prior))
        if objective - before <= tolerance * abs(objective):
            return LabelModel(names, float(prior), tables)
        before = objective
    raise RuntimeError("the label model did not settle")


def _counts(texts: pa.Array) -> list[pa.Array]:
    counts = measure(texts)
    return [pa.array(counts[name], pa.int64()) for name in STATS.names]


def stats_of(docs: DataFrame, key: str | None = None, text: str = "text") -> DataFrame:
    """The counts of ``STATS`` for every text, behind the key if one is named. Judged in place, without a shuffle."""
    keys = [docs.schema[key]] if key else []
    narrow = docs.select(*[F.col(f.name) for f in keys], F.col(text).alias("_text"))

    def add(batches):
        for batch in batches:
            for part in slices(batch, "_text"):
                columns = part.columns[:-1] + _counts(part.column("_text"))
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[:-1], *STATS.names])

    return narrow.mapInArrow(add, T.StructType([*keys, *STATS.fields]))


def fit(stats: DataFrame) -> LabelModel:
    """Label model of a table with the columns of ``STATS``. The driver sees one row for each distinct pattern
    of votes, 3**10 at most whatever the number of rows."""
    voted = stats.select(*(vote.alias(name) for name, vote in rules().items()))
    rows = voted.groupBy(*voted.columns).count().collect()
    names = voted.columns
    return fit_label_model(np.array([[r[n] for n in names] for r in rows]), np.array([r["count"] for r in rows]), names)


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs``: the key, the counts, a vote by rule, ``posterior`` and ``kept``.

    A row is kept when it passes the two base rules (20 words at least, at most 30 % of them repeated) and its
    posterior is ``threshold`` or more. A null or empty text has no words and fails; repeated rows get the same
    verdict; an empty table gives no rows; other columns are not read. The model is fitted on all rows.
    """
    stats = stats_of(docs, key, text)
    model = fit(stats)
    votes = rules()
    failed = base_failed()
    return stats.select(
        "*",
        *(vote.alias(f"vote_{name}") for name, vote in votes.items()),
        model.posterior(votes).alias("posterior"),
        failed.alias("base_failed"),
        (~failed & (model.posterior(votes) >= threshold)).alias("kept"),
    )


def keep_good(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, columns as they are. Texts are read twice and never shuffled."""
    model = fit(stats_of(docs, None, text))
    rows = whole_rows(docs)
    place = docs.columns.index(text)

    def add(batches):
        for batch in batches:
            for part, texts in row_slices(batch, place):
                yield pa.RecordBatch.from_arrays([part, *_counts(texts)], ["_row", *STATS.names])

    judged = rows.mapInArrow(add, T.StructType([*rows.schema.fields, *STATS.fields]))
    return judged.where(~base_failed() & (model.posterior(rules()) >= threshold)).select("_row.*")
