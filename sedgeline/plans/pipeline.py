"""Steps as a graph: each names its inputs and an operator; only stale ones run."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from sedgeline.operators.incremental import merged_by_key


@dataclass(frozen=True)
class Step:
    name: str
    inputs: tuple[str, ...]
    run: Callable[..., DataFrame]
    always: bool = False


@dataclass
class Pipeline:
    """Tables live under root, one folder a step. A step is stale if its output is absent or older than
    an input, if one of its inputs was just rebuilt, or if it always runs."""

    spark: SparkSession
    root: str
    steps: list[Step] = field(default_factory=list)

    def step(self, name: str, *inputs: str, always: bool = False):
        def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            self.steps.append(Step(name, inputs, f, always))
            return f

        return add

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def written_at(self, name: str) -> int | None:
        """When the step's folder was completed, by its success mark; null if never."""
        jvm = self.spark.sparkContext._jvm
        mark = jvm.org.apache.hadoop.fs.Path(self.path(name) + "/_SUCCESS")
        fs = mark.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.getFileStatus(mark).getModificationTime() if fs.exists(mark) else None

    def order(self) -> list[Step]:
        """Steps after their inputs; a circle raises."""
        by, done, out = {s.name: s for s in self.steps}, set(), []

        def visit(s: Step, above: tuple[str, ...]) -> None:
            if s.name in above:
                raise ValueError(f"steps in a circle: {' > '.join((*above, s.name))}")
            if s.name not in done:
                for i in s.inputs:
                    if i in by:
                        visit(by[i], (*above, s.name))
                done.add(s.name)
                out.append(s)

        for s in self.steps:
            visit(s, ())
        return out

    def stale(self, s: Step, rebuilt: Iterable[str]) -> bool:
        mine = self.written_at(s.name)
        times = [self.written_at(i) for i in s.inputs]
        return s.always or mine is None or bool(set(s.inputs) & set(rebuilt)) or any(t is not None and t > mine for t in times)

    def run(self, only: DataFrame | None = None, key: str | None = None) -> list[str]:
        """Run the stale steps in order; names them. With `only` (keys), rebuilt rows replace those of its keys, the rest stay."""
        rebuilt: list[str] = []
        for s in self.order():
            if not self.stale(s, rebuilt):
                continue
            out = s.run(*[self.read(i) for i in s.inputs])
            if only is not None and key in out.columns and self.written_at(s.name) is not None:
                out = merged_by_key(self.read(s.name), out, only, key)
                out.write.mode("overwrite").parquet(self.path(s.name) + ".next")
                out = self.read(s.name + ".next")
            out.write.mode("overwrite").parquet(self.path(s.name))
            rebuilt.append(s.name)
        return rebuilt
