"""Numbers of text categories kept in a table, for columns with more labels than the driver should list.

`StringIndexer` collects every label and keeps them in the model. Here the distinct labels of all columns are
sorted by range over the tasks and numbered by their place in the order; the numbers stay a table. Rows meet
it in a left join per column: the planner sends the table along where it is small and splits a hot label
of the rows where it is not. The numbers are those of `StringIndexer` with ``alphabetAsc`` and ``keep``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohorta.learning.stages import Saved, _Fitted
from cohorta.session import default_buckets, materialize, new_workspace


def number_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, label, number): the labels of each column numbered from 0 in their byte order; nulls have none.

    Only the number of labels per column and range is shuffled into one place. A range holds an
    even share of the distinct labels, whatever their counts in the rows.
    """
    spark = df.sparkSession
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("label")) for c in columns]))
    labels = df.select(pairs.alias("_p")).select("_p.*").where("label IS NOT NULL").distinct()
    ranged = labels.repartitionByRange(default_buckets(spark), "column", "label")
    # written once: a range computed again might be cut elsewhere
    kept = materialize(ranged.withColumn("part", F.spark_partition_id()), "labels")
    sizes = kept.groupBy("column", "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("column").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("column", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(W.partitionBy("column", "part").orderBy("label")) - 1
    placed = kept.withColumn("place", place).join(F.broadcast(offsets), ["column", "part"])
    return placed.select("column", "label", (F.col("offset") + F.col("place")).alias("number"))


class CategoryTableModel(_Fitted):
    """Adds ``outputs``: the number of a row's label, or the count of labels for null and unseen ones."""

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("column string, label string, number bigint").parquet(self.fitted()["path"])

    @property
    def sizes(self) -> dict[str, int]:
        return self.fitted()["sizes"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        state, numbers = self.fitted(), self.table(dataset.sparkSession)
        names = [*dataset.columns, *[o for o in state["outputs"] if o not in dataset.columns]]
        for column, output in zip(state["inputs"], state["outputs"], strict=True):
            size = state["sizes"][column]
            own = numbers.where(F.col("column") == column).select(
                F.col("label").alias("_label"), F.col("number").alias("_number")
            )
            # one more than there are labels: the encoder drops the last, so null and unseen are all zeros
            about = {"ml_attr": {"type": "nominal", "name": output, "num_vals": size + 1}}
            number = F.coalesce("_number", F.lit(size)).cast("double")
            dataset = (
                dataset.join(own, F.col(column).cast("string") == F.col("_label"), "left")
                .withColumn(output, number.alias(output, metadata=about))
                .drop("_label", "_number")
            )
        return dataset.select(*names)


class CategoryTable(Estimator, Saved):
    """Numbers the labels of ``inputs``; the driver gets one count a column."""

    def __init__(self, inputs: Sequence[str] = (), outputs: Sequence[str] = ()):
        super().__init__()
        if len(inputs) != len(outputs):
            raise ValueError("Every input column needs an output column.")
        self.inputs, self.outputs = list(inputs), list(outputs)

    def _fit(self, dataset: DataFrame) -> CategoryTableModel:
        spark = dataset.sparkSession
        path = new_workspace(spark, "categories")
        number_labels(dataset, self.inputs).write.parquet(path)
        counted = spark.read.parquet(path).groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()
        sizes = dict.fromkeys(self.inputs, 0) | {r["column"]: r["n"] for r in counted}
        return CategoryTableModel({"path": path, "inputs": self.inputs, "outputs": self.outputs, "sizes": sizes})
