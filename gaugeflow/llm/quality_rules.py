"""Operator 5, quality rules: a decision list learned from labelled statistics.

Every text gets statistics (below). From a bounded sample of labelled ones, sequential
covering learns conjunctions of thresholds that hold for texts of low quality: a rule
grows by the condition with the largest information gain, loses its last conditions where
that does better on rows set aside, and the rows it covers are taken out before the next
rule. The list becomes one Spark conditional expression, in the order of the rules.

Null and empty texts have no words and fail the base rule. Rows with the same doc_id stay
apart; a doc_id that is labelled more than once counts as low quality if any label says
so. Without labels of both kinds no rule is learned and the base rule decides. An empty
table gives no rows, other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow import session
from gaugeflow.llm import words
from gaugeflow.llm.tables import bounded_sample, give_back, text_key

#: Labelled documents of each kind, and as many of their distinct rows, that a list is learned from.
SAMPLE_ROWS = 4000
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30
SYMBOLS = b"#*$%&|<>"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_lines", "n_upper",
    "n_letters", "n_marks",
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATS = "struct<" + ",".join(f"{name}:bigint" for name in COUNTS) + ">"
WHITE = words.WHITE.decode()


def _flags(values: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


IS_SYMBOL = _flags(SYMBOLS)
IS_UPPER = _flags(bytes(range(65, 91)))
IS_LETTER = _flags(bytes([*range(65, 91), *range(97, 123)]))
IS_MARK = _flags(b"!?")
IS_HEAD = _flags(bytes([*range(0x80), *range(0xC0, 0x100)]))


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Whether each key is there twice or more."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return twice


def _lines(text: str | None) -> tuple[int, int]:
    """Lines with a word, and those equal to an earlier one."""
    said = [x for x in (text or "").split("\n") if x.strip(WHITE)]
    return len(said), len(said) - len(set(said))


def statistics(column: pa.Array) -> pa.StructArray:
    """The counts of every text of an Arrow column, as a struct."""
    made: dict[str, list[np.ndarray]] = {name: [] for name in COUNTS}
    for block in words.blocks(column, words.SPACED):
        text_of, hashes = block.text_of(), block.hashes()
        own = words.mixed(text_of.astype(np.uint64) + np.uint64(1))
        window, whole = block.shingles(hashes, WINDOW)
        at = np.flatnonzero(whole)
        twice = at[_repeats(words.mixed(window[at] ^ own[at]))]
        change = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(change, twice, 1)
        np.add.at(change, twice + WINDOW, -1)
        covered = np.cumsum(change[:-1]) > 0
        # A key is of one text, so the first row of each distinct key tells the text.
        _, representative = np.unique(words.mixed(hashes ^ own), return_index=True)
        inside = block.read != 0x20
        counts = {
            "n_words": np.diff(block.of),
            "word_chars": _per_text(inside & IS_HEAD[block.raw], block.offsets),
            "n_symbols": _per_text(IS_SYMBOL[block.raw], block.offsets),
            "n_repeat_words": _per_text(covered, block.of),
            "n_distinct": np.bincount(text_of[representative], minlength=block.texts),
            "n_upper": _per_text(IS_UPPER[block.raw], block.offsets),
            "n_letters": _per_text(IS_LETTER[block.raw], block.offsets),
            "n_marks": _per_text(IS_MARK[block.raw], block.offsets),
        }
        for name, values in counts.items():
            made[name].append(values)
    lines = np.array([_lines(x) for x in column.to_pylist()], np.int64).reshape(-1, 2)
    made["n_lines"], made["n_dup_lines"] = [lines[:, 0]], [lines[:, 1]]
    arrays = [pa.array(np.concatenate(made[n]) if made[n] else np.zeros(0), pa.int64()) for n in COUNTS]
    return pa.StructArray.from_arrays(arrays, list(COUNTS))


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of its text."""

    @F.arrow_udf(STATS)
    def count(text: pa.Array) -> pa.Array:
        made = statistics(text)
        give_back()
        return made

    return docs.select("doc_id", count("text").alias("s")).select("doc_id", "s.*")


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def features() -> dict[str, Column]:
    """What rules look at, as expressions over the counts."""
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": _share("word_chars", "n_words"),
        "symbol_share": _share("n_symbols", "word_chars"),
        "duplicate_lines": _share("n_dup_lines", "n_lines"),
        "repeated_words": _share("n_repeat_words", "n_words"),
        "distinct_words": _share("n_distinct", "n_words"),
        "upper_share": _share("n_upper", "n_letters"),
        "mark_share": _share("n_marks", "word_chars"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        values = table[self.feature]
        return values > self.threshold if self.above else values <= self.threshold

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def _covers(rule: Rule, table: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(table.values()))), bool)
    for condition in rule:
        out &= condition.holds(table)
    return out


def _grow(table: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray, most: int) -> Rule:
    rule: list[Condition] = []
    inside = rows.copy()
    while len(rule) < most and (inside & ~bad).any() and (inside & bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        best, best_gain = None, 1e-9
        for name, values in table.items():
            cuts = np.unique(np.quantile(values[inside], np.linspace(0, 1, 65)))
            cuts = (cuts[1:] + cuts[:-1]) / 2
            for above in (True, False):
                for cut in cuts:
                    held = inside & Condition(name, above, float(cut)).holds(table)
                    p, n = (held & bad).sum(), (held & ~bad).sum()
                    if p:
                        gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                        if gain > best_gain:
                            best, best_gain = Condition(name, above, float(cut)), gain
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(table)
    return tuple(rule)


def learn_rules(
    table: dict[str, np.ndarray], bad: np.ndarray, most_conditions: int = 3, precision: float = 0.95, least: int = 4
) -> list[Rule]:
    """Conjunctions that hold for bad rows, in order; the rows must be in a random order."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    aside = np.arange(len(bad)) % 3 == 2
    while (left & bad).any():
        rule = _grow(table, bad, left & ~aside, most_conditions)
        if not rule:
            break

        def worth(shorter: Rule) -> float:
            held = _covers(shorter, table) & left & aside
            p, n = (held & bad).sum(), (held & ~bad).sum()
            return (p - n) / (p + n) if p + n else -1.0

        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)
        held = _covers(rule, table) & left
        p, n = (held & bad).sum(), (held & ~bad).sum()
        if p < least or p < precision * (p + n) or worth(rule) < 2 * precision - 1:
            break
        rules.append(rule)
        left &= ~held
    return rules


def kept(rules: list[Rule]) -> Column:
    """The decision list as one conditional expression."""
    out = F.when(base_failed(), F.lit(False))
    for rule in rules:
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.column()
        out = out.when(holds, F.lit(False))
    return out.otherwise(F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn from at most sample_rows documents of each quality."""
    once = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = bounded_sample(once, "quality", sample_rows)
    named = {name: column.alias(f"f_{name}") for name, column in features().items()}
    # At most two classes of sample_rows ids, but an id may have many rows; equal ones count once.
    known = docs.select("doc_id", "text", text_key().alias("k"))
    keys = (
        known.join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "k", "quality", F.xxhash64("doc_id", "k").alias("row"))
        .distinct()
    )
    taken = bounded_sample(session.stage(keys, "rows"), "quality", sample_rows, "row").select("doc_id", "k")
    texts = known.join(F.broadcast(taken), ["doc_id", "k"]).distinct()
    rows = (
        with_statistics(texts)
        .join(F.broadcast(chosen), "doc_id")
        .where(~base_failed())
        .select("doc_id", (F.col("quality") == 0).alias("bad"), *named.values())
        .orderBy(F.xxhash64("doc_id"), *(f"f_{x}" for x in named))
        .toPandas()
    )
    if rows.empty:
        return []
    table = {name: rows[f"f_{name}"].to_numpy(float) for name in named}
    return learn_rules(table, rows["bad"].to_numpy(bool))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the counts of the base, base_failed and kept, then the other counts."""
    verdict = [base_failed().alias("base_failed"), kept(rules).alias("kept")]
    other = [name for name in COUNTS if name not in BASE]
    return with_statistics(docs).select("doc_id", *BASE, *verdict, *other)
