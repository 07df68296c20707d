"""Versions of a slowly changing dimension, stored as a base and one delta a snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.operators.scd2 import scd2_apply, scd2_changes
from strataflow.session import stage
from strataflow.sources import schemas
from strataflow.sources.tables import MARKER, TableStore, _children, path_exists

#: After this many deltas they are folded into the base.
MOST_DELTAS = 64


class VersionHistory:
    """History of one dimension: a table of the store, and beside it what changed since.

    A snapshot writes only the versions it opens or closes; files already
    written are never touched.  A delta counts once its marker is there.  Deltas
    are folded into a new base when they hold more rows than the base, or when
    there are ``most_deltas``, so that rewriting costs a constant part of what
    the changes cost.
    """

    def __init__(
        self,
        store: TableStore,
        name: str,
        key: str,
        check_cols: Sequence[str],
        contract: T.StructType | None = None,
        *,
        invalidate_hard_deletes: bool = True,
        most_deltas: int = MOST_DELTAS,
    ):
        self.store = store
        self.name = name
        self.key = key
        self.check_cols = check_cols
        self.contract = contract
        self.invalidate_hard_deletes = invalidate_hard_deletes
        self.most_deltas = most_deltas

    def _root(self) -> str:
        version = self.store.path(self.name).rsplit("/", 1)[-1]
        return f"{self.store.root}/_deltas/{self.name}/{version}"

    def _deltas(self) -> list[tuple[int, datetime]]:
        """Number and time of the deltas that count, in order; of one time the last written."""
        found: dict[datetime, int] = {}
        for child in _children(self.store.spark, self._root()):
            if child.startswith("d") and path_exists(self.store.spark, f"{self._root()}/{child}/{MARKER}"):
                number, _, stamp = child[1:].partition("_")
                at = datetime.strptime(stamp, "%Y%m%dT%H%M%S%f")
                found[at] = max(found.get(at, 0), int(number))
        return sorted((n, at) for at, n in found.items())

    def _path(self, number: int, at: datetime) -> str:
        return f"{self._root()}/d{number}_{at.strftime('%Y%m%dT%H%M%S%f')}"

    def _contracted(self, df: DataFrame) -> DataFrame:
        return df if self.contract is None else schemas.read_contract(df, self.contract)

    def _folded(self, deltas: Sequence[tuple[int, datetime]]) -> DataFrame:
        base = self.store.read(self.name)
        if not deltas:
            return self._contracted(base)
        number = F.regexp_extract("_metadata.file_path", r"/d(\d+)_[^/]*/[^/]*$", 1).cast("int")
        reader = self.store.spark.read.schema(base.schema)
        changes = reader.parquet(*[self._path(*d) for d in deltas]).select(*base.columns, number.alias("_delta"))
        rows = base.withColumn("_delta", F.lit(0)).unionByName(changes).alias("r")
        later = changes.select("dbt_scd_id", "_delta").alias("l")
        replaced = (F.col("r.dbt_scd_id") == F.col("l.dbt_scd_id")) & (F.col("l._delta") > F.col("r._delta"))
        return self._contracted(rows.join(later, replaced, "left_anti").drop("_delta"))

    def read(self) -> DataFrame:
        """All versions: a row gives way to a later one of the same identity.

        The deltas are few next to the base, so the planner broadcasts the
        identities in them and the base is not shuffled.
        """
        return self._folded(self._deltas())

    def snapshot(self, current: DataFrame, as_of: datetime | str) -> DataFrame:
        """The history after a snapshot of the current state, see ``scd2_apply``.

        A snapshot of the time of the newest delta takes its place, one without
        changes writes nothing, an earlier one is refused.
        """
        if not self.store.exists(self.name):
            first = scd2_apply(None, current, self.key, self.check_cols, as_of)
            self.store.write(self.name, first)
            return self.read()
        now = datetime.fromisoformat(str(as_of))
        deltas = self._deltas()
        again = bool(deltas) and max(at for _, at in deltas) == now
        before = [d for d in deltas if d[1] < now]
        if len(before) + again < len(deltas):
            raise ValueError(f"the history has changes after {as_of}")
        options = {"invalidate_hard_deletes": self.invalidate_hard_deletes}
        if not deltas and not self._is_after_base(now, as_of):
            # The snapshot that is the newest in the base is taken again.
            whole = scd2_apply(self._folded([]), current, self.key, self.check_cols, as_of, **options)
            self.store.write(self.name, whole)
            return self.read()
        changes = scd2_changes(self._folded(before), current, self.key, self.check_cols, as_of, **options)
        changes = stage(changes.select(self.store.read(self.name).columns), f"{self.name}-changes")
        if again or not changes.isEmpty():
            number = max((n for n, _ in deltas), default=0) + 1
            changes.write.mode("overwrite").parquet(self._path(number, now))
            self._compact_if_due()
        return self.read()

    def _is_after_base(self, now: datetime, as_of: datetime | str) -> bool:
        """Whether a snapshot is later than all of the base; earlier ones are refused."""
        changed = F.max(F.greatest("dbt_updated_at", "dbt_valid_from", "dbt_valid_to"))
        last = self.store.read(self.name).agg(changed).first()[0]
        if last is not None and last > now:
            raise ValueError(f"the history has changes after {as_of}")
        return last is None or last < now

    def _compact_if_due(self) -> None:
        deltas = self._deltas()
        held = self.store.spark.read.parquet(*[self._path(*d) for d in deltas]).count()
        if len(deltas) >= self.most_deltas or held > self.store.read(self.name).count():
            self.compact()

    def compact(self) -> None:
        """Fold the deltas into a new base; the old one and its deltas stay until dropped."""
        self.store.write(self.name, self.read())
