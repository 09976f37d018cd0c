"""Mixed-type feature preparation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    Bucketizer,
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import DataFrame

FEATURES = "features"


@dataclass(frozen=True)
class FeatureSpec:
    """Numeric and categorical predictors and the label they explain.

    Categories are indexed by frequency on the driver, so they are meant for columns of
    at most thousands of values.
    """

    numeric: Sequence[str]
    categorical: Sequence[str]
    label: str

    def __post_init__(self) -> None:
        if self.label in (*self.numeric, *self.categorical):
            raise ValueError(f"the label {self.label} is among the predictors")

    @property
    def predictors(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def stages(self, edges: Mapping[str, Sequence[float]] | None = None) -> list:
        """Index and one-hot encode the categories, then assemble one vector.

        All the columns are indexed by one stage, which is one job.  A category unseen
        in training has a slot of its own; a null number is an error.  With `edges`, numbers
        enter as the number of the bin that they fall into.
        """
        indexed = [f"{name}_idx" for name in self.categorical]
        encoded = [f"{name}_ohe" for name in self.categorical]
        numbers, binning = list(self.numeric), []
        if edges is not None and numbers:
            numbers = [f"{name}_step" for name in self.numeric]
            open_ends = (float("-inf"), float("inf"))
            binning = [
                Bucketizer(
                    splitsArray=[
                        # A column of one bin still needs an inner edge to be split at.
                        [open_ends[0], *(edges[name] or [0.0]), open_ends[1]] for name in self.numeric
                    ],
                    inputCols=list(self.numeric),
                    outputCols=[f"{name}_bin" for name in self.numeric],
                    handleInvalid="error",
                ),
                # A bin's number marked as a category would be split by sets, not by order;
                # a computed column has no mark.
                SQLTransformer(
                    statement="SELECT *, "
                    + ", ".join(f"`{name}_bin` + 0D AS `{name}_step`" for name in self.numeric)
                    + " FROM __THIS__"
                ),
            ]
        assembler = VectorAssembler(
            inputCols=[*numbers, *encoded], outputCol=FEATURES, handleInvalid="error"
        )
        if not self.categorical:
            return [*binning, assembler]
        return [
            *binning,
            StringIndexer(
                inputCols=list(self.categorical),
                outputCols=indexed,
                handleInvalid="keep",
                stringOrderType="frequencyDesc",
            ),
            OneHotEncoder(
                inputCols=indexed, outputCols=encoded, handleInvalid="keep", dropLast=True
            ),
            assembler,
        ]

    def slots(self) -> list[str]:
        """What rows hold before they are encoded, if numbers enter as bins."""
        return [*[f"{name}_step" for name in self.numeric], *[f"{name}_idx" for name in self.categorical]]

    def fit(
        self, train: DataFrame, edges: Mapping[str, Sequence[float]] | None = None
    ) -> PipelineModel:
        return Pipeline(stages=self.stages(edges)).fit(train.select(*self.predictors))
