"""Column permutation and permutation importance.

Rows have global ranks in the order of their ids, and a repeat is a permutation of all ranks that is computed, not
drawn: a Feistel network over two digits of the rank, keyed by seed and repeat, stepped on where it leaves the table.
The row whose values a row receives is thus known by arithmetic, whatever the size, and meets it in one join of narrow
rows for each repeat. The features of a repeat are shuffled alike, one at a time, so that join serves all of them.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FIT, default
from ..functions.columns import as_double, col
from ..functions.lookups import settle
from ..functions.ranking import global_rank
from .metrics import minmax_normalize

ROUNDS = 6
PRIME = 2**31 - 1
STEPS = 64
NOISE_THRESHOLD = 0.01


def digits(n: int) -> tuple[int, int]:
    """Two radices whose product covers n numbers and less than one more row of the first."""
    first = math.isqrt(max(n, 1) - 1) + 1
    return first, -(-max(n, 1) // first)


def network(x: str, first: str | int, second: str | int, seed: int, repeat: int, div: str = "div") -> str:
    """SQL of one pass of a rank through the network: a permutation of the numbers below first * second."""
    rng = random.Random(f"{seed}/{repeat}")
    left, right = f"({x} {div} {second})", f"({x} % {second})"
    for i in range(ROUNDS):
        times, plus = rng.randrange(1 << 20, 1 << 30), rng.randrange(PRIME)
        if i % 2:
            right = f"(({right} + ({left} * {times} + {plus}) % {PRIME}) % {second})"
        else:
            left = f"(({left} + ({right} * {times} + {plus}) % {PRIME}) % {first})"
    return f"({left} * {second} + {right})"


def _by_repeat(made, repeats: Sequence[int]) -> str:
    return "CASE _repeat " + " ".join(f"WHEN {r} THEN {made(r)}" for r in repeats) + " END"


def donor_ranks(rows: DataFrame, n: int, seed: int, repeats: Sequence[int]) -> DataFrame:
    """Adds `_donor`, the rank that each row of `_rank` and `_repeat` is sent to by its repeat.

    A pass that ends outside the table goes on; each step leaves it less often than one time in the root of n, and never
    more than the few numbers outside follow one another, so that the steps allowed always end inside.
    """
    first, second = digits(n)
    once = _by_repeat(lambda r: network("_rank", first, second, seed, r), repeats)
    again = _by_repeat(lambda r: network("x", first, second, seed, r), repeats)
    walked = f"aggregate(sequence(1, {STEPS}), _donor, (x, i) -> CASE WHEN x < {n} THEN x ELSE {again} END)"
    return rows.withColumn("_donor", F.expr(once)).withColumn("_donor", F.expr(f"CASE WHEN _donor < {n} THEN _donor ELSE {walked} END"))


def permute_column(df: DataFrame, id_cols: Sequence[str], column: str, seed: int | None = None, repeat: int = 0) -> DataFrame:
    """The frame with one column shuffled among all its rows and the others in place."""
    ranked = global_rank(df, [col(c) for c in id_cols], "_rank")
    n = ranked.count()
    sent = donor_ranks(ranked.withColumn("_repeat", F.lit(repeat)), n, default(seed, FIT.seed), [repeat])
    values = ranked.select(F.col("_rank").alias("_donor"), col(column).alias("_value"))
    return sent.join(values, "_donor").select(*[F.col("_value").alias(c) if c == column else col(c) for c in df.columns])


def permuted_errors(
    df: DataFrame,
    model: Transformer,
    features: Sequence[str],
    label: str,
    id_cols: Sequence[str],
    n_repeats: int = 10,
    seed: int | None = None,
    prediction: str = "prediction",
) -> DataFrame:
    """(feature, repeat, mse); feature NULL is the untouched baseline.

    A row meets the values of its donor once in a repeat, and is scored once for each feature.
    """
    xs = F.array(*[as_double(df, f) for f in features]).alias("_xs")
    narrow = df.select(*[col(c).alias(f"_id{i}") for i, c in enumerate(id_cols)], as_double(df, label).alias("_y"), xs)
    ranked = global_rank(narrow, [F.col(f"_id{i}") for i in range(len(id_cols))], "_rank").select("_rank", "_y", "_xs")
    n = ranked.count()
    repeats = range(n_repeats)
    each = ranked.withColumn("_repeat", F.explode(F.array(*[F.lit(r) for r in repeats])))
    met = donor_ranks(each, n, default(seed, FIT.seed), repeats).join(
        ranked.select(F.col("_rank").alias("_donor"), F.col("_xs").alias("_other")), "_donor")
    jobs = met.select("_y", "_xs", "_other", "_repeat", F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1))).alias("_f"))
    none = F.lit(None)
    base = ranked.select("_y", "_xs", none.cast("array<double>").alias("_other"), none.cast("int").alias("_repeat"), F.lit(-1).alias("_f"))
    swapped = [F.when(F.col("_f") == i, F.col("_other")[i]).otherwise(F.col("_xs")[i]).alias(f) for i, f in enumerate(features)]
    scored = model.transform(jobs.union(base).select("_f", "_repeat", "_y", *swapped))
    e = F.col("_y") - F.col(prediction)
    names = F.array(*[F.lit(f) for f in features])
    return scored.groupBy("_f", "_repeat").agg(F.avg(e * e).alias("mse")).select(
        F.when(F.col("_f") >= 0, F.get(names, F.col("_f"))).alias("feature"), F.col("_repeat").alias("repeat"), "mse")


def importance_from_errors(errors: DataFrame) -> DataFrame:
    """(feature, importance_mean, importance_std), largest first; the table has features x repeats rows."""
    base = F.max(F.when(F.col("feature").isNull(), F.col("mse"))).alias("base")
    scores = F.collect_list(F.when(F.col("feature").isNotNull(), F.struct("feature", "mse"))).alias("s")
    drops = (
        errors.agg(base, scores)
        .select("base", F.explode("s").alias("s"))
        .select(F.col("s.feature").alias("feature"), (F.col("s.mse") - F.col("base")).alias("drop"))
    )
    return (
        drops.groupBy("feature")
        .agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
        .orderBy(F.desc("importance_mean"), "feature")
    )


def permutation_importance(df: DataFrame, model: Transformer, features, label, id_cols, **options) -> DataFrame:
    return importance_from_errors(permuted_errors(df, model, features, label, id_cols, **options))


def top_features(importance: DataFrame, n: int = 20, score: str = "importance_mean") -> DataFrame:
    return importance.orderBy(F.desc(score), "feature").limit(n)


def low_importance(importance: DataFrame, threshold: float = NOISE_THRESHOLD) -> DataFrame:
    return importance.filter(F.col("importance_mean") <= threshold)


def compare_importance(permutation: DataFrame, shap: DataFrame, top_n: int = 15) -> DataFrame:
    """(feature, permutation, shap, avg_importance): both scaled to [0, 1] over the union of tops.

    Each table is computed once: it has a row for each feature, and is read for its top, its span and its values.
    """
    permutation, shap = settle(permutation).table, settle(shap).table
    left = minmax_normalize(permutation, "importance_mean", "permutation")
    right = minmax_normalize(shap, "importance", "shap")
    tops = (
        top_features(permutation, top_n).select("feature")
        .union(top_features(shap, top_n, "importance").select("feature"))
        .distinct()
    )
    return (
        tops.join(left.select("feature", "permutation"), "feature", "left")
        .join(right.select("feature", "shap"), "feature", "left")
        .fillna(0.0, ["permutation", "shap"])
        .withColumn("avg_importance", (F.col("permutation") + F.col("shap")) / 2)
        .orderBy(F.desc("avg_importance"), "feature")
        .limit(top_n)
    )


def permutation_report(
    df: DataFrame, model: Transformer, features, label, id_cols, shap_importance: DataFrame | None = None,
    top_n: int = 20, **options
) -> dict:
    """Importance, its top, the comparison with SHAP and the noisy features."""
    importance = settle(permutation_importance(df, model, features, label, id_cols, **options)).table
    return {
        "importance": importance,
        "top": top_features(importance, top_n),
        "comparison": None if shap_importance is None else compare_importance(importance, shap_importance, top_n),
        "noisy": low_importance(importance),
    }
