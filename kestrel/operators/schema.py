"""Projection and filter operators.  All narrow (no shuffle)
except ``dedup_rows``, whose map-side partial aggregation collapses hot
groups of copies before the exchange."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The signal table's forbidden columns, by reason.
KOI_POLICY: dict[str, list[str]] = {
    "identifiers": ["rowid", "kepid", "kepoi_name", "kepler_name"],
    "leakage": [
        "koi_pdisposition", "koi_fpflag_nt", "koi_fpflag_ss", "koi_fpflag_co", "koi_fpflag_ec",
        "koi_vet_stat", "koi_vet_date", "koi_disp_prov", "koi_comment", "koi_score",
    ],
    "metadata": [
        "koi_fittype", "koi_limbdark_mod", "koi_trans_mod", "koi_parm_prov", "koi_sparprov",
        "koi_tce_delivname", "koi_quarters", "koi_datalink_dvr", "koi_datalink_dvs",
    ],
}
KOI_TARGET = "koi_disposition"
# The signal table's class order.
KOI_CLASSES = ["FALSE POSITIVE", "CANDIDATE", "CONFIRMED"]


def policy_columns(policy: dict[str, Sequence[str]]) -> list[str]:
    return [c for reason in policy.values() for c in reason]


def drop_forbidden(df: DataFrame, policy: dict[str, Sequence[str]], target: str | None = None,
                   keep: Iterable[str] = ()) -> DataFrame:
    """Drop every policy column that is present (absent names are
    ignored) and the target; ``keep`` restores a subset (leakage benchmark).
    Catalyst prunes the dropped columns out of the scan's ReadSchema."""
    keep = set(keep)
    forbidden = [c for c in policy_columns(policy) if c not in keep]
    if target:
        forbidden.append(target)
    present = set(df.columns)
    return df.drop(*[c for c in forbidden if c in present])


def surviving_forbidden(df: DataFrame, policy: dict[str, Sequence[str]], target: str | None = None) -> list[str]:
    """Audit: forbidden names still present (should be empty)."""
    bad = set(policy_columns(policy)) | ({target} if target else set())
    return [c for c in df.columns if c in bad]


def align_schema(df: DataFrame, columns: Sequence[str], dtype: str = "double") -> DataFrame:
    """Exactly ``columns`` in order; absent ones as typed NULL; extras dropped."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(None).cast(dtype).alias(c) for c in columns])


def labelled_rows(df: DataFrame, label: str) -> DataFrame:
    """P1."""
    return df.filter(F.col(label).isNotNull())


def dedup_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Exact duplicate removal over ``cols`` (default all); NULL equals NULL."""
    return df.dropDuplicates(list(cols)) if cols else df.dropDuplicates()


def class_subset(df: DataFrame, label: str, classes: Sequence) -> DataFrame:
    """P7."""
    return df.filter(F.col(label).isin(list(classes)))


def positive_complete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where every listed column is present and > 0."""
    cond: Column = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull() & (F.col(c) > 0)
    return df.filter(cond)


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by an explicit key (Spark has no row order);
    planned as TakeOrderedAndProject, a per-partition top-n then one merge."""
    return df.orderBy(*order_by).limit(n)
