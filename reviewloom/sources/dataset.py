"""Column specs: logical names, the physical columns behind them, arrays widened to indexed columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Dataset:
    """``columns`` maps logical to physical names; ``arrays`` gives the width of indexed ones."""

    name: str
    columns: Mapping[str, str]
    required: frozenset[str] = frozenset()
    arrays: Mapping[str, int] = field(default_factory=dict)

    def __post_init__(self):
        undeclared = self.required - set(self.columns)
        if undeclared:
            raise ValueError(f"{self.name}: required columns are not declared: {sorted(undeclared)}")
        physical = list(self.columns.values())
        repeated = sorted({c for c in physical if physical.count(c) > 1})
        if repeated:
            raise ValueError(f"{self.name}: physical names are used twice: {repeated}")
        for logical, width in self.arrays.items():
            if logical not in self.columns:
                raise ValueError(f"{self.name}: array {logical} is not a declared column")
            if not isinstance(width, int) or width < 1:
                raise ValueError(f"{self.name}: array {logical} needs a width of at least 1")

    def __contains__(self, logical: str) -> bool:
        return logical in self.columns

    def __getitem__(self, logical: str) -> str:
        return self.columns[logical]

    def get(self, logical: str) -> str | None:
        return self.columns.get(logical)

    def indexed(self, logical: str) -> list[str]:
        """Physical names ``name1 … nameN`` of an array column."""
        return [indexed_name(self.columns[logical], i) for i in range(1, self.arrays[logical] + 1)]

    def flat(self) -> dict[str, str]:
        """Flat mapping in declared order; an array ``A`` becomes ``A.1 … A.N``."""
        result: dict[str, str] = {}
        for logical, physical in self.columns.items():
            if logical in self.arrays:
                for i, name in enumerate(self.indexed(logical), start=1):
                    result[f"{logical}.{i}"] = name
            else:
                result[logical] = physical
        return result

    def prefixed(self, prefix: str) -> Dataset:
        return Dataset(
            name=self.name,
            columns={k: prefix + v for k, v in self.columns.items()},
            required=self.required,
            arrays=self.arrays,
        )

    def require(self, df: DataFrame) -> DataFrame:
        """Fail when ``df`` lacks a declared column."""
        require_columns(df, self.flat().values(), self.name)
        return df

    def empty(self, spark) -> DataFrame:
        """No rows, every declared column as text."""
        schema = T.StructType([T.StructField(c, T.StringType()) for c in self.flat().values()])
        return spark.createDataFrame([], schema)


def indexed_name(name: str, index: int) -> str:
    return f"{name}{index}"


def require_columns(df: DataFrame, names: Iterable[str], what: str = "table") -> None:
    missing = [n for n in dict.fromkeys(names) if n not in df.columns]
    if missing:
        raise ValueError(f"{what}: required columns are missing: {missing}")


def check_created_columns(reviews: Dataset) -> None:
    """A review table declares a creation timestamp, or a date and a time."""
    if "REVIEW_CREATED_DATETIME" in reviews:
        return
    if "REVIEW_CREATED_DATE" in reviews and "REVIEW_CREATED_TIME" in reviews:
        return
    raise ValueError(f"{reviews.name}: declare REVIEW_CREATED_DATETIME, or both REVIEW_CREATED_DATE and REVIEW_CREATED_TIME")


def check_order_ids(reviews: Dataset, orders: Dataset) -> None:
    """Both sides of the order-history join declare the order id."""
    for side in (reviews, orders):
        if "ORDER_ID" not in side:
            raise ValueError(f"{side.name}: ORDER_ID must be declared to join the order history")
