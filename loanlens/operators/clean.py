"""Cleaning and temporal splitting."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.plans.prefix import exact_quantiles

from loanlens.functions.columns import literal_map, names_with_prefix

# Fixed values from the reference's cleaning rules.
RESOLVED_STATUSES = ("Fully Paid", "Charged Off")
DEFAULT_STATUS = "Charged Off"
LEAKAGE_COLUMNS = ("total_pymnt", "recoveries", "total_rec_prncp", "out_prncp",
                   "total_rec_int", "last_pymnt_amnt")
LEAKAGE_PREFIXES = ("hardship_", "settlement_")
REDUNDANT_COLUMNS = ("fico_range_high", "funded_amnt", "installment", "grade",
                     "addr_state", "total_acc")
ISSUE_DATE_FORMAT = "MMM-yyyy"
TARGET, ISSUE_D, ISSUE_YEAR = "default", "issue_d", "issue_year"


@dataclass(frozen=True)
class SplitSpec:
    """Calendar-year windows.  Rows of other or NULL years fall in no split."""
    train_years: tuple[int, ...] = (2013, 2014, 2015)
    val_year: int = 2016
    test_year: int = 2017
    drift_year: int | None = 2018
    extra: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def labelled_years(self) -> list[tuple[str, tuple[int, ...]]]:
        out = [("train", tuple(self.train_years)), ("val", (self.val_year,)),
               ("test", (self.test_year,))]
        if self.drift_year is not None:
            out.append((f"drift_{self.drift_year}", (self.drift_year,)))
        out += [(k, tuple(v)) for k, v in self.extra.items()]
        return out


#: Split used on the driver's tables: 1995–97 / 1998 / 1999 / 2000 / 2001.
DRIVER_SPLITS = SplitSpec((1995, 1996, 1997), 1998, 1999, 2000, {"extra_2001": (2001,)})


def resolve_target(df: DataFrame, status_col: str = "loan_status") -> DataFrame:
    """B1 + B2: keep resolved loans, add ``default`` int.  NULL status drops."""
    return (df.where(F.col(status_col).isin(*RESOLVED_STATUSES))
              .withColumn(TARGET, (F.col(status_col) == F.lit(DEFAULT_STATUS)).cast("int")))


def parse_issue_date(df: DataFrame, col: str = ISSUE_D) -> DataFrame:
    """``Mon-YYYY`` text → DATE and ``issue_year``; bad text → NULL.

    ``try_to_date`` keeps unparseable text NULL under ANSI mode.  A table
    without the column is returned unchanged.
    """
    if col not in df.columns:
        return df
    parsed = F.try_to_date(F.col(col), ISSUE_DATE_FORMAT)
    return df.withColumn(col, parsed).withColumn(ISSUE_YEAR, F.year(col))


def drop_leakage(df: DataFrame) -> DataFrame:
    """Drop post-issuance columns by exact name or prefix (absent ignored)."""
    gone = set(LEAKAGE_COLUMNS) | set(names_with_prefix(df.columns, LEAKAGE_PREFIXES))
    return df.drop(*[c for c in df.columns if c in gone])


def drop_redundant(df: DataFrame) -> DataFrame:
    """Drop the six redundant features (absent ignored)."""
    return df.drop(*[c for c in df.columns if c in REDUNDANT_COLUMNS])


def clean(df: DataFrame) -> DataFrame:
    """The reference's cleaning order: filter → target → dates → drops."""
    return drop_redundant(drop_leakage(parse_issue_date(resolve_target(df))))


def split_label(year: Column, spec: SplitSpec) -> Column:
    """Year → split label (the first that lists it), NULL when the year is in no window.

    One look-up, so ``year`` is worked out once where a filter repeats the
    label's expression, not once per window: it stands for a parsed date.
    """
    labels: dict[int, str] = {}
    for label, years in spec.labelled_years():
        for y in years:
            labels.setdefault(y, label)
    return F.try_element_at(literal_map(labels), year)


def temporal_split(df: DataFrame, spec: SplitSpec = DRIVER_SPLITS,
                   keep_unassigned: bool = False) -> DataFrame:
    """Add ``split``; rows in no window are dropped unless asked to keep."""
    if ISSUE_YEAR not in df.columns:
        raise ValueError("temporal_split needs an 'issue_year' column")
    out = df.withColumn("split", split_label(F.col(ISSUE_YEAR), spec))
    return out if keep_unassigned else out.where(F.col("split").isNotNull())


def feature_columns(df: DataFrame, exclude=(TARGET, ISSUE_D, ISSUE_YEAR)) -> DataFrame:
    """Every column except the target and the date columns."""
    return df.select(*[c for c in df.columns if c not in set(exclude)])


def listwise_drop(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``subset``."""
    return df.na.drop(subset=subset)


def trim_upper_quantile(df: DataFrame, col: str, q: float = 0.99) -> DataFrame:
    """Keep rows with ``col`` ≤ its q-quantile.

    The quantile is exact and one number, which becomes a literal in the
    filter, so the filter can still reach the scan.  A column without a value
    keeps no row.
    """
    cut = exact_quantiles(df, {col: F.col(f"`{col}`")}, [q]).get(col)
    return df.where(F.col(f"`{col}`") <= F.lit(cut[0] if cut else None).cast("double"))
