"""The feature store: portal and trading features of every user side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import exact_quantiles
from ..session import cut_lineage
from ..schemas import KEY, LABEL, PORTAL_FEATURES, STORE_FEATURES, TRADE_FEATURES


def prefixed(features: DataFrame, names: list[str], prefix: str) -> DataFrame:
    return features.select(KEY, *[F.col(n).cast("double").alias(f"{prefix}{n}") for n in names],
                           F.col(LABEL).alias(f"{prefix}label"))


def feature_store(portal: DataFrame, trading: DataFrame) -> DataFrame:
    """Full outer join on the user. Trading features of non-traders are 0; portal features of
    users without portal events stay null. Labels are combined with OR."""
    merged = (prefixed(portal, PORTAL_FEATURES, "p_")
              .join(prefixed(trading, TRADE_FEATURES, "t_"), KEY, "full"))
    false = F.lit(False)
    label = F.coalesce("p_label", false) | F.coalesce("t_label", false)
    return (merged.na.fill(0.0, [f"t_{c}" for c in TRADE_FEATURES])
            .select(KEY, *STORE_FEATURES, label.alias(LABEL)))


def feature_columns(store: DataFrame, prefix: str | None = None) -> list[str]:
    """Feature columns in store order, optionally only those with a name prefix."""
    names = [c for c in store.columns if c not in (KEY, LABEL)]
    return [c for c in names if prefix is None or c.startswith(prefix)]


def imputed(store: DataFrame, how: str = "median") -> DataFrame:
    """Nulls of feature columns replaced by the column's exact median, or by 0."""
    names = feature_columns(store)
    if how == "zero":
        return store.na.fill(0.0, names)
    store = cut_lineage(store, "store")
    medians = {c: q[0] for c, q in exact_quantiles(store, names, [0.5], stored=True).items()}
    return store.na.fill({c: m for c, m in medians.items() if m == m})


def feature_counts(store: DataFrame) -> dict[str, int]:
    """Number of features in total and per source."""
    return {"total": len(feature_columns(store)),
            "portal": len(feature_columns(store, "p_")),
            "trading": len(feature_columns(store, "t_"))}
