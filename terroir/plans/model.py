"""The feature-and-regression job (R3): feature table, imputation, split,
scaling, random forest, metrics, importances, learning curve, correlation
and missingness tables. Everything stays a DataFrame; only column-level
aggregates (medians, moments, metrics) reach the driver."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.functions.numeric import ratio
from terroir.operators import features as G
from terroir.operators import forests
from terroir.operators import stats as A
from terroir.operators.filters import not_null_le
from terroir.operators.joins import join_suffixed
from terroir.operators.quality import null_profile
from terroir.quirks import PARITY, Quirks
from terroir.session import ensure_checkpoint_dir

# The candidate features of the original notebook, in order;
# only those present in the joined table are used.
CANDIDATE_FEATURES = [
    "inscrits_t1", "votants_t1", "blancs_t1", "nuls_t1", "exprimes_t1",
    "taux_participation_t1", "taux_blancs_t1", "taux_nuls_t1",
    "pop_1564", "tx_emploi", "med21", "tx_pauv",
]
TARGET = "taux_participation_t2"


VOTE_COUNTS = ["inscrits", "abstentions", "votants", "blancs", "nuls", "exprimes"]


def per_key_totals(df: DataFrame, key: str, measures: Sequence[str] = VOTE_COUNTS) -> DataFrame:
    """One row per key with summed counts (partial aggregation before the
    shuffle, so a key holding many rows costs one row per map task)."""
    present = [c for c in measures if c in df.columns]
    return df.groupBy(key).agg(*[F.sum(c).alias(c) for c in present])


def build_feature_table(t1: DataFrame, t2: DataFrame, enrichments: Sequence[DataFrame],
                        key: str = "codgeo", target: str = TARGET,
                        aggregate_rounds: bool = True) -> DataFrame:
    """G1: round 1 x round 2 (inner, suffixes _t1/_t2), LEFT joins of the
    enrichment tables (suffixes _x/_y on overlap), ratio features, target
    ratio, and the target filter (not NULL, <= 1).

    Each round's counts are summed per key first, so one row meets one row
    whatever share of the rows a key holds. `aggregate_rounds=False` joins the
    rounds row by row as the original notebook does: every pair of a key's rows,
    which grows with the square of a key's rows."""
    if aggregate_rounds:
        t1, t2 = per_key_totals(t1, key), per_key_totals(t2, key)
    j = join_suffixed(t1, t2, key, "inner", ("_t1", "_t2"))
    for e in enrichments:
        j = join_suffixed(j, e, key, "left", ("_x", "_y"))
    cols = [F.col(c) for c in j.columns]
    if {"blancs_t1", "votants_t1"} <= set(j.columns):
        cols.append(ratio("blancs_t1", "votants_t1").alias("taux_blancs_t1"))
    if {"nuls_t1", "votants_t1"} <= set(j.columns):
        cols.append(ratio("nuls_t1", "votants_t1").alias("taux_nuls_t1"))
    cols.append(ratio("votants_t2", "inscrits_t2").alias(target))
    return not_null_le(j.select(*cols), target, 1.0)


class ModelResult:
    """The job's tables, each made when first asked for: the correlation and
    missingness tables neither split nor fit; metrics, importance and
    predictions share one forest, the curve grows its own."""

    def __init__(self, raw: DataFrame, base: DataFrame, split: Callable[[DataFrame], DataFrame], key: str, features: list[str],
                 target: str, num_trees: int, max_depth: int, seed: int, curve_trees: int | None, train_only: bool, quirks: Quirks):
        self._raw, self._base, self._to_split = raw, base, split
        self._key, self._features, self._target = key, features, target
        self._trees, self._depth, self._seed, self._curve_trees = num_trees, max_depth, seed, curve_trees
        self._train_only, self._quirks = train_only, quirks

    @cached_property
    def _split(self) -> DataFrame:
        return self._to_split(self._base)

    @cached_property
    def _medians(self) -> dict:
        # the original fills with medians of the whole table before the split
        source = self._split.filter(F.col("split") == "train") if self._train_only else self._base
        return A.exact_medians(source, self._features)

    @cached_property
    def _scaled(self) -> DataFrame:
        """Filled, then scaled with the training rows' moments (population deviation, centred)."""
        filled = A.median_fill(self._split, self._features, medians=self._medians)
        train = filled.filter(F.col("split") == "train")
        return A.zscore(filled, self._features, params=A.moments(train, self._features))

    @cached_property
    def _grown(self) -> forests.Grown:
        """One fit: the training rows, with the test rows to be scored."""
        member = F.struct(F.lit(0).alias("fit"), (F.col("split") == "train").alias("train"))
        rows = self._scaled.select(F.col(ROW).alias("row"), forests.key_hash([self._key], self._seed).alias("h"),
                                   F.array(*self._features).alias("x"), F.col(self._target).alias("y"), F.array(member).alias("fits"))
        return forests.grow(rows, len(self._features), self._trees, self._depth, self._seed)

    @cached_property
    def predictions(self) -> DataFrame:
        """Key, actual and predicted value of the test rows. Grouped by row alone,
        so that a query of the actual values drops the join and grows no forest."""
        got = self._grown.predictions.filter(~F.col("train")).groupBy(F.col("row").alias(ROW)).agg(F.max("predicted").alias("predicted"))
        test = self._split.filter(F.col("split") == "test").select(self._key, F.col(self._target).alias("actual"), ROW)
        return test.join(got, ROW, "left").select(self._key, "actual", "predicted")

    @cached_property
    def metrics(self) -> DataFrame:
        m = A.regression_metrics(self.predictions, "actual", "predicted")
        legacy = F.col("mse") if self._quirks.rmse_is_mse else F.col("rmse")
        return m.select("mae", "mse", "rmse", legacy.alias("reported_rmse"), "r2", F.lit(len(self._features)).alias("n_features"))

    @cached_property
    def importance(self) -> DataFrame:
        return G.grown_importance(self._grown, self._features)

    @cached_property
    def correlation(self) -> DataFrame:
        return A.corr_matrix(A.median_fill(self._base, self._features, medians=self._medians), self._features)

    @cached_property
    def missing(self) -> DataFrame:
        return null_profile(self._raw)

    @cached_property
    def curve(self) -> DataFrame | None:
        if self._curve_trees is None:
            return None
        rows = G.learning_curve(self._scaled.filter(F.col("split") == "train"), self._features, self._target, [self._key],
                                num_trees=self._curve_trees, max_depth=self._depth, seed=self._seed)
        return self._raw.sparkSession.createDataFrame(rows, "train_fraction double, train_r2 double, valid_r2 double")


ROW = "_row"  # number of a row in the written feature table


def run_model(table: DataFrame, key: str, features: Sequence[str] | None = None,
              target: str = TARGET, num_trees: int = 100, max_depth: int = 30, seed: int = 42,
              test_fraction: float = 0.2, curve: bool = False, curve_trees: int | None = None,
              impute_on_train_only: bool = False, quirks: Quirks = PARITY,
              split_bucket=None) -> ModelResult:
    """R3 on a feature table with one row per `key`. The test split has the
    original's exact size, unless `split_bucket` (a bucket of 0 to 999 per row)
    decides. Forests are fitted on all training rows. The learning curve grows
    `num_trees` trees a fit too unless `curve_trees` is given."""
    spark = table.sparkSession
    ensure_checkpoint_dir(spark)
    feats = [c for c in (features or CANDIDATE_FEATURES) if c in table.columns]
    # one row per key: written once to the shared checkpoint folder, so the
    # statistics passes and the fits re-read it instead of re-running joins
    base = table.select(key, *[F.col(c).cast("double").alias(c) for c in feats], F.col(target).cast("double").alias(target),
                        F.monotonically_increasing_id().alias(ROW)).checkpoint(eager=True)
    def split(df: DataFrame) -> DataFrame:
        if split_bucket is None:
            return G.exact_split(df, [key], test_fraction, seed)
        return G.hash_split(df, [key], test_fraction, seed, bucket=split_bucket)

    trees = None if not curve else num_trees if curve_trees is None else curve_trees
    return ModelResult(table, base, split, key, feats, target, num_trees, max_depth, seed, trees, impute_on_train_only, quirks)


def run_from_warehouse(spark, output_path: str | None = None, num_trees: int = 100, max_depth: int = 30, curve: bool = False,
                       quirks: Quirks = PARITY, aggregate_rounds: bool = True) -> ModelResult:
    """R3 as the notebook runs it: the two election rounds, employment and
    income facts from the published warehouse tables, joined on `codgeo`.
    `output_path` attaches the run published there; without it the session's
    tables are read."""
    if output_path:
        from terroir.plans.etl import attach
        attach(spark, output_path)
    t1 = spark.table("fact_election_tour1")
    t2 = spark.table("fact_election_tour2")
    table = build_feature_table(t1, t2, [spark.table("fact_emploi_pop_active"),
                                         spark.table("fact_revenus")], key="codgeo",
                                aggregate_rounds=aggregate_rounds)
    return run_model(table, key="codgeo", num_trees=num_trees, max_depth=max_depth, curve=curve,
                     quirks=quirks)


__all__ = ["CANDIDATE_FEATURES", "TARGET", "VOTE_COUNTS", "per_key_totals", "build_feature_table",
           "ModelResult", "run_model", "run_from_warehouse"]
