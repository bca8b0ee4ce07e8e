"""The cohort preparation chain shared by the flagship query, training and scoring.

validate -> drop constant columns -> normalise (log2 | z-score, fill, batch centre)
-> standardise -> impute -> [drop outlier-prone features] -> [resample]

The reference screens for outliers after resampling; here the screen judges the rows as
they were measured, so that drawn copies of a row do not weigh on a feature's share.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from cohort_engine.operators import columns as C
from cohort_engine.operators import outliers as O
from cohort_engine.operators import prep as P
from cohort_engine.sources.tables import nan_to_null


@dataclass
class PreparedModel:
    features: list[str]
    normalizer: P.NormalizerModel
    scaler: P.ScalerModel
    imputer: P.ImputerModel
    removed: list[str] = field(default_factory=list)

    @property
    def kept(self) -> list[str]:
        return [c for c in self.features if c not in self.removed]

    def frozen(self, df: DataFrame) -> PreparedModel:
        """This model with the statistics of ``df`` in place of those of each frame it transforms."""
        return replace(self, normalizer=P.FrozenNormalizer(self.normalizer, nan_to_null(C.encode_sex(df))))

    def transform(self, df: DataFrame) -> DataFrame:
        df = nan_to_null(C.encode_sex(df))
        out = self.normalizer.transform(df)
        out = self.scaler.transform(out)
        out = self.imputer.transform(out)
        return C.drop_features(out, self.removed)


@dataclass
class Preparer:
    features: list[str]
    batch_col: str | None = "batch"
    stats: str = "self"
    outlier_method: str | None = None
    outlier_params: dict = field(default_factory=dict)
    keep: bool = True                    # the normalised rows; not worth it when the caller reads them once

    def fit(self, df: DataFrame) -> tuple[PreparedModel, DataFrame]:
        """Fit on ``df`` and return the model with the transformed training rows.

        The input and the normalised rows are persisted (each feeds several
        statistics jobs); ``release()`` drops them.  Input that the caller has
        persisted is not stored a second time.  The median imputer (T7) is
        fitted empty: the bad-value fill (T3) has already replaced every NULL, so
        its medians could never be used.
        """
        self._cached = []
        stored = df.storageLevel.useMemory or df.storageLevel.useDisk
        df = nan_to_null(C.encode_sex(df))
        df = df if stored else self._keep(df)
        normalizer = P.Normalizer(self.features, self.batch_col, self.stats)
        norm, normed = normalizer.fit_transform(df)
        normed = self._keep(normed) if self.keep or self.outlier_method else normed
        mom = getattr(normalizer, "out_moments", None)
        if mom is not None:              # centred data: mean 0, pooled within-batch spread
            scaler = P.ScalerModel(list(self.features), {c: 0.0 for c in self.features},
                                   {c: (mom[c][1] if mom[c][1] else 1.0) for c in self.features})
        else:
            scaler = P.StandardScaler(self.features).fit(normed)
        scaled = scaler.transform(normed)
        imputer = P.ImputerModel([], {})
        out = imputer.transform(scaled)
        removed: list[str] = []
        if self.outlier_method:
            removed = O.flagged(O.report(out, self.features, self.outlier_method, **self.outlier_params))
            if len(removed) == len(self.features):
                raise ValueError(f"outlier screening '{self.outlier_method}' flagged every feature")
            out = C.drop_features(out, removed)
        return PreparedModel(self.features, norm, scaler, imputer, removed), out

    def _keep(self, df: DataFrame) -> DataFrame:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._cached.append(df)
        return df

    def release(self) -> None:
        for d in getattr(self, "_cached", []):
            d.unpersist()
        self._cached = []


def cohort_features(df: DataFrame, response: str = "response", batch: str = "batch") -> list[str]:
    return C.feature_columns(C.encode_sex(df), response=response, batch=batch)
