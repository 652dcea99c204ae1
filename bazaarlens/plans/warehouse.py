"""The layered warehouse: every table, what it is built from, and where it is stored.

``derive`` gives a table as a lazy plan over stored upstream tables; ``table``
stores it on first use and scans the stored copy; ``refresh`` rebuilds one table
and publishes the new version only after its key holds. Stored tables are plain
Parquet in shared storage, so lost executors cost a rescan, never a rebuild.
"""

from __future__ import annotations

import json
import time
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import date, timedelta
from functools import reduce
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bazaarlens.operators.bitmaps import numbered_lists
from bazaarlens.operators.keys import key_reports, require_key
from bazaarlens.operators.scratch import release, stored
from bazaarlens.plans import intermediate, marts, monthly, seller_history, staging
from bazaarlens.schemas import RAW_COLUMNS
from bazaarlens.sources.buckets import (
    BUCKETS,
    WIDE_ROWS,
    Dealt,
    forget_buckets,
    read_buckets,
    write_buckets,
)
from bazaarlens.sources.files import Files, abandoned_scratch, written_at
from bazaarlens.sources.layout import LAYOUTS, read_table, write_table


@dataclass(frozen=True)
class Table:
    """One stored table: its layer, its builder and its key."""

    layer: str
    build: Callable[[Warehouse], DataFrame]
    key: tuple[str, ...]
    nulls_in_key: bool = False
    checked: bool = True
    #: Raw tables it is built from, loaded anew when it is refreshed.
    raw: tuple[str, ...] = ()
    #: Stored tables it is built from.
    inputs: tuple[str, ...] = ()


@dataclass(frozen=True)
class Version:
    """Where one version of a table lies; ``buckets``: of its copy by key, 0 without one."""

    path: str
    schema: StructType
    buckets: int = 0
    #: The copy has very frequent keys apart from its buckets.
    wide: bool = False
    #: Named parts of the table with a few facts each: its months and their digests, or files.
    parts: Mapping[str, list] = field(default_factory=dict)

    @property
    def copy(self) -> str:
        return f"{self.path}-by-key"

    def files(self) -> list[str]:
        """Paths that its parts name."""
        named = [x for value in self.parts.values() for x in value if "/" in str(x)]
        return [*named, *(name for name in self.parts if "/" in name)]


@dataclass(frozen=True)
class ByKey:
    """Names the bucketed copy of a table as an input."""

    name: str


class Warehouse:
    """Tables of one raw source, stored under one root folder.

    ``buckets``: files of each copy by key, by default as many as the session has
    shuffle partitions, so that a bucket is about as large as a shuffled partition.
    Keys with more than ``wide_rows`` rows lie apart from the buckets.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        raw: Callable[[str], DataFrame],
        *,
        buckets: int | None = None,
        wide_rows: int = WIDE_ROWS,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.wide_rows = wide_rows
        self._source = raw
        self._versions: dict[str, Version] = {}
        self._one_at_a_time = RLock()
        self._files = Files(spark)

    @classmethod
    def reopen(
        cls, spark: SparkSession, root: str, raw: Callable[[str], DataFrame]
    ) -> Warehouse:
        """The warehouse already stored under ``root``, at its published versions."""
        warehouse = cls(spark, root, raw)
        warehouse._load_published()
        return warehouse

    def raw(self, name: str) -> DataFrame:
        """A raw table, loaded from the source on first use."""
        if f"raw_{name}" not in self._versions:
            self._publish({f"raw_{name}": self._load(name)})
        return self._scan(self._versions[f"raw_{name}"])

    def derive(self, name: str) -> DataFrame:
        """The table as a plan over its stored inputs.

        The table itself is not written, but its inputs are stored first if they are
        not yet, and tables that rank whole sides of the data write scratch copies
        while the plan is made.
        """
        self.gather(TABLES[name].inputs)
        return TABLES[name].build(self)

    def gather(self, names: Iterable[str], *, together: int = 4) -> None:
        """Store those of these tables, and of what they are built from, that are not yet.

        Tables that do not read each other are written ``together``, as in ``build``. A
        broken key raises; tables of earlier steps stay published.
        """
        missing: set[str] = set()
        left = list(names)
        while left:
            name = left.pop()
            if name not in self._versions and name not in missing:
                missing.add(name)
                left += TABLES[name].inputs
        if not missing:
            return
        wanted = {raw for name in missing for raw in TABLES[name].raw}
        raws = [raw for raw in RAW_COLUMNS if raw in wanted and f"raw_{raw}" not in self._versions]
        with ThreadPoolExecutor(together) as writers:
            loaded = writers.map(self._load, raws)
            self._publish({f"raw_{n}": v for n, v in zip(raws, loaded, strict=True)})
            for step in BUILD_STEPS:
                some = [name for name in step if name in missing]
                self._publish(dict(zip(some, writers.map(self._checked, some), strict=True)))

    def table(self, name: str) -> DataFrame:
        """The stored table, built, checked and published first if necessary.

        A broken key raises and publishes nothing.
        """
        self.gather((name,))
        return self._scan(self._versions[name])

    def by_key(self, name: str) -> DataFrame | Dealt:
        """The copy of a stored table in buckets of its join key.

        A plain scan where a key has one row; else a key's rows may lie apart.
        """
        self.table(name)
        return self._copy(name, self._versions[name])

    def read(self, source: str | ByKey) -> DataFrame | Dealt:
        """A stored table or, for ``ByKey``, its copy in buckets."""
        return self.by_key(source.name) if isinstance(source, ByKey) else self.table(source)

    def refresh(self, name: str) -> DataFrame:
        """Rebuild one table, check its key, then publish the new version.

        A staging table's raw tables are loaded anew. A failed check leaves the
        published version in place. Readers of the old version keep their files.
        """
        self._publish({f"raw_{raw}": self._load(raw) for raw in TABLES[name].raw})
        self._publish({name: self._checked(name)})
        return self.table(name)

    def build(self, *, check_keys: bool = True, together: int = 4) -> None:
        """Rebuild all layers in order. A broken key aborts the build.

        Tables that do not read each other are written ``together``, so the tail
        of one job does not leave the cluster idle.
        """
        self._versions = {}

        rebuild = self._checked if check_keys else self._write
        with ThreadPoolExecutor(together) as writers:
            loaded = writers.map(self._load, RAW_COLUMNS)
            self._publish({f"raw_{n}": v for n, v in zip(RAW_COLUMNS, loaded, strict=True)})
            for step in BUILD_STEPS:
                self._publish(dict(zip(step, writers.map(rebuild, step), strict=True)))

    def month_states(self) -> tuple[DataFrame, DataFrame]:
        """Sums and persons of each month of the enriched orders, as ``monthly`` merges them.

        States are stored. Only months whose orders differ from those that the stored states
        were made of are read and summed up again.
        """
        with self._one_at_a_time:
            enriched = self.table(_MONTHLY)
            digests = self._versions[_MONTHLY].parts
            before = self._versions.get(_STATES, Version("", StructType())).parts
            changed = [m for m, told in digests.items() if before.get(m, [None])[:1] != told[:1]]
            if changed or len(digests) != len(before):
                path = f"{self.root}/state/months/v{time.time_ns()}"
                if changed:
                    some = len(changed) < len(digests)
                    self._sum_up(enriched.filter(_in_months(changed)) if some else enriched, path)
                parts = {
                    m: [*told[:1], path if m in changed else before[m][1]]
                    for m, told in digests.items()
                }
                self._publish({_STATES: Version(path, StructType(), parts=parts)})
            return self._state("sums"), self._state("words")

    def extend_history(self) -> DataFrame:
        """Merge the months after the last one of the stored seller history, one by one.

        Orders, items and sellers are those now stored. Each month writes the ranges that it
        closed and the open ones; files of closed ranges are never written again. Orders
        before the last month that were added or changed since need a rebuild (``refresh``).
        """
        history = self.table(_HISTORY)
        orders, items = self.by_key("stg_orders"), self.by_key("stg_order_items")
        span, told = seller_history.span_of_months(self.table("stg_orders")), "months"
        months = [] if span is None else _months_after(self._versions[_HISTORY].parts[told], span)
        with_orders = {
            row[0]
            for row in seller_history.order_months(self.table("stg_orders"))
            .select("month_start")
            .filter(F.col("month_start").isin(months or [None]))
            .collect()
        }
        for month in (m for m in months if m in with_orders):
            version = self._versions[_HISTORY]
            known = version.parts[told]
            first = date.fromisoformat(known[0]) if known else month
            # the newest file has the open ranges; before the first merge it has all
            current = self._scan(replace(version, parts={"files": version.parts["files"][-1:]}))
            merged = seller_history.merged_month(
                current.filter("is_current"),
                self.table("stg_sellers"),
                items,
                orders,
                month=month,
                first_month=first,
                last_key=history.agg(F.coalesce(F.max("scd_id"), F.lit(0))).first()[0],
            )
            merged, path = stored(merged), f"{self.root}/intermediate/{_HISTORY}/v{time.time_ns()}"
            closed, opened = f"{path}/closed", f"{path}/open"
            write_table(merged.filter(~F.col("is_current")), closed, LAYOUTS[_HISTORY])
            write_table(merged.filter("is_current"), opened, LAYOUTS[_HISTORY])
            before = version.parts["files"][:-1]
            if version.parts["files"][-1] == version.path and not before:
                # ranges closed by the build lie with those it left open
                ended = f"{path}/built"
                write_table(current.filter(~F.col("is_current")), ended, LAYOUTS[_HISTORY])
                before = [ended]
            release(merged)
            parts = _span((first, month), [*before, closed, opened])
            self._publish({_HISTORY: Version(path, version.schema, parts=parts)})
            history = self.table(_HISTORY)
        return history

    def _sum_up(self, enriched: DataFrame, path: str) -> None:
        people = stored(monthly.month_people(enriched))
        numbers = self._person_numbers(people.select(F.col(monthly.PERSON).alias("id")).distinct())
        for name, states in (
            ("sums", monthly.month_sums(enriched)),
            ("words", monthly.month_words(people, numbers)),
        ):
            states.write.partitionBy(*monthly.MONTH).parquet(f"{path}/{name}")
        release(people)

    def _state(self, kind: str) -> DataFrame:
        """The stored states of all months; each path has those that were written together."""
        by_path: dict[str, list[str]] = defaultdict(list)
        for month, (_, path) in self._versions[_STATES].parts.items():
            by_path[path].append(month)
        reader = self.spark.read.schema(monthly.STATES[kind])
        if not by_path:
            return self.spark.createDataFrame([], monthly.STATES[kind])
        parts = [
            reader.parquet(f"{path}/{kind}").filter(_in_months(months))
            for path, months in by_path.items()
        ]
        return reduce(DataFrame.unionByName, parts)

    def _person_numbers(self, ids: DataFrame) -> DataFrame:
        """Numbers of all persons met so far; persons not met before get the next ones."""
        known = self._versions.get(_PERSONS, Version("", StructType()))
        reader = self.spark.read.schema("id string, _number bigint")
        new = ids
        if known.parts:
            new = ids.join(reader.parquet(*known.parts), "id", "left_anti")
        (numbered,) = numbered_lists(new)
        met = sum(count for (count,) in known.parts.values())
        path = f"{self.root}/state/persons/v{time.time_ns()}"
        numbered.select("id", (F.col("_number") + met).alias("_number")).write.parquet(path)
        parts = {**known.parts, path: [reader.parquet(path).count()]}
        self._publish({_PERSONS: Version(path, StructType(), parts=parts)})
        return reader.parquet(*parts)

    def key_report(self, layers: tuple[str, ...]) -> DataFrame:
        """Key violations of every checked table in the given layers."""
        checked = {n: s for n, s in TABLES.items() if s.layer in layers and s.checked}
        self.gather(checked)
        return key_reports({name: (self._keyed(name), s.key) for name, s in checked.items()})

    def _keyed(self, name: str, version: Version | None = None) -> DataFrame | Dealt:
        """The table as its key is checked: by its copy, if that is dealt by the key.

        A copy is made from the stored table and has all of its rows.
        """
        if version is None:
            self.table(name)
            version = self._versions[name]
        dealt_by = BUCKETS[name].key if version.buckets else None
        return self._copy(name, version) if dealt_by == TABLES[name].key[0] else self._scan(version)

    def _copy(self, name: str, version: Version) -> DataFrame | Dealt:
        spec = BUCKETS[name]
        copy = read_buckets(
            self.spark, version.copy, version.schema, spec, version.buckets, version.wide
        )
        return copy.bucketed if spec.unique else copy

    def _load(self, name: str) -> Version:
        df = self._source(name)
        version = Version(f"{self.root}/raw/{name}/v{time.time_ns()}", df.schema)
        write_table(df, version.path)
        return version

    def _write(self, name: str) -> Version:
        df = self.derive(name)
        version = Version(f"{self.root}/{TABLES[name].layer}/{name}/v{time.time_ns()}", df.schema)
        write_table(df, version.path, LAYOUTS.get(name))
        if name == _MONTHLY:
            version = replace(version, parts=_month_digests(self._scan(version)))
        if name == _HISTORY:
            span = seller_history.span_of_months(self.table("stg_orders"))
            version = replace(version, parts=_span(span, [version.path]))
        if name not in BUCKETS:
            return version
        wide = write_buckets(
            self._scan(version), version.copy, BUCKETS[name], self.buckets, self.wide_rows
        )
        return replace(version, buckets=self.buckets, wide=wide)

    def _checked(self, name: str) -> Version:
        """A new version of the table, whose key holds."""
        version, spec = self._write(name), TABLES[name]
        if spec.checked:
            keyed = self._keyed(name, version)
            require_key(name, keyed, spec.key, allow_null=spec.nulls_in_key)
        return version

    def _scan(self, version: Version) -> DataFrame:
        files = version.parts.get("files", [version.path])
        return read_table(self.spark, files, version.schema)

    def _publish(self, versions: Mapping[str, Version]) -> None:
        """Make versions the current ones: a new manifest names them and all others.

        Manifests are never changed. A reader takes the newest one that was completed, so it
        sees all of a publication or nothing, and one that it has opened keeps its files.
        """
        if not versions:
            return
        with self._one_at_a_time:
            current = {**self._versions, **versions}
            entries = [
                F.struct(
                    F.lit(name).alias("name"),
                    F.lit(version.path).alias("path"),
                    F.lit(version.schema.json()).alias("schema"),
                    F.lit(version.buckets).alias("buckets"),
                    F.lit(version.wide).alias("wide"),
                    F.lit(json.dumps(dict(version.parts))).alias("parts"),
                )
                for name, version in current.items()
            ]
            manifest = self.spark.range(1, numPartitions=1).select(F.inline(F.array(*entries)))
            manifest.write.parquet(f"{self.root}/{_MANIFESTS}/v{time.time_ns()}")
            self._versions = current

    def _manifests(self) -> list[str]:
        """Completed manifests, the newest last."""
        found = self._files.under(f"{self.root}/{_MANIFESTS}")
        return sorted((p for p in found if self._files.exists(f"{p}/_SUCCESS")), key=written_at)

    def _manifest(self, path: str) -> dict[str, Version]:
        rows = self.spark.read.schema(
            "name string, path string, schema string, buckets int, wide boolean, parts string"
        ).parquet(path)
        # One row per table of the warehouse.
        return {
            row["name"]: Version(
                row["path"],
                StructType.fromJson(json.loads(row["schema"])),
                row["buckets"],
                row["wide"],
                json.loads(row["parts"]),
            )
            for row in rows.collect()
        }

    def _load_published(self) -> None:
        if newest := self._manifests()[-1:]:
            self._versions = self._manifest(newest[0])

    def vacuum(self, keep_seconds: float = 7 * 24 * 3600) -> list[str]:
        """Delete what no manifest of the last ``keep_seconds`` names, and say what that was.

        The newest manifest counts whatever its age, and any that was superseded no longer
        ago than that: its readers may still be at work. What was begun within that
        time is kept too, published or not, as its job may be running. Gone are older
        versions, those whose key check or job failed, and old manifests. Scratch copies of
        this session are deleted by those who made them, of ended sessions here.
        """
        limit = time.time_ns() - int(keep_seconds * 1e9)
        manifests = self._manifests()
        # one is in use until the next one is written
        ended = [*(written_at(p) for p in manifests[1:]), None]
        kept = [p for p, end in zip(manifests, ended, strict=False) if end is None or end >= limit]
        used = set()
        for path in kept:
            for version in self._manifest(path).values():
                used |= {version.path, version.copy, *version.files()}
        gone = [p for p in manifests if p not in kept]
        for layer in _FOLDERS:
            for name in self._files.under(f"{self.root}/{layer}"):
                for version in self._files.under(name):
                    named = any(u == version or u.startswith(f"{version}/") for u in used)
                    if not named and written_at(version) < limit:
                        gone.append(version)
        gone += abandoned_scratch(self.spark, self._files, limit)
        for path in gone:
            forget_buckets(self.spark, path)
            self._files.delete(path)
        return gone


_MANIFESTS = "manifests"
_FOLDERS = ("raw", "staging", "intermediate", "mart", "state")
_MONTHLY, _STATES, _PERSONS = "int_orders_enriched", "month_states", "person_numbers"
_HISTORY = "int_seller_status_history"


def _span(months: tuple[date, date] | None, files: list[str]) -> dict[str, list]:
    """Parts of the seller history: its first and last month, files with the open ranges last."""
    return {"months": [m.isoformat() for m in months or ()], "files": files}


def _months_after(known: Sequence[str], span: tuple[date, date]) -> list[date]:
    """Calendar months after the last known one, to the end of ``span``."""
    first = date.fromisoformat(known[1]) if known else None
    month, found = first or span[0], [] if first else [span[0]]
    while month < span[1]:
        month = (month.replace(day=28) + timedelta(days=4)).replace(day=1)
        found.append(month)
    return found


def _month_digests(enriched: DataFrame) -> dict[str, list]:
    """A digest of the orders of each month, whatever their order; one row per month."""
    rows = (
        enriched.groupBy(*monthly.MONTH)
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(F.xxhash64(*monthly.FACTS).cast("decimal(20,0)")).alias("digest"),
        )
        .collect()
    )
    return {
        json.dumps([row[c] for c in monthly.MONTH]): [f"{row['orders']}:{row['digest']}"]
        for row in rows
    }


def _in_months(months: Sequence[str]) -> Column:
    """Does a row lie in one of these months? On folder columns only, so others stay shut."""
    each = [
        reduce(
            lambda a, b: a & b,
            [F.col(c).eqNullSafe(v) for c, v in zip(monthly.MONTH, json.loads(m), strict=True)],
        )
        for m in months
    ]
    return reduce(lambda a, b: a | b, each)


def _staged(build: Callable[..., DataFrame], key: tuple[str, ...], *raw: str) -> Table:
    return Table("staging", lambda w: build(*[w.raw(r) for r in raw]), key, raw=raw)


def _stored(
    layer: str,
    build: Callable[..., DataFrame],
    key: tuple[str, ...],
    *inputs: str | ByKey,
    **options: bool,
) -> Table:
    names = tuple(i.name if isinstance(i, ByKey) else i for i in inputs)
    return Table(
        layer, lambda w: build(*[w.read(i) for i in inputs]), key, inputs=names, **options
    )


_VIEW = {"nulls_in_key": True}  # unique, but NULL is allowed

TABLES: dict[str, Table] = {
    "stg_customers": _staged(staging.customers, ("customer_id",), "customers"),
    "stg_orders": _staged(staging.orders, ("order_id",), "orders"),
    "stg_order_items": _staged(
        staging.order_items, ("order_id", "order_item_id"), "order_items"
    ),
    "stg_order_payments": _staged(
        staging.order_payments, ("order_id", "payment_sequential"), "order_payments"
    ),
    "stg_order_reviews": _staged(staging.order_reviews, ("order_id",), "order_reviews"),
    "stg_products": _staged(
        staging.products, ("product_id",), "products", "category_translation"
    ),
    "stg_sellers": _staged(staging.sellers, ("seller_id",), "sellers"),
    "stg_geolocation": _staged(staging.geolocation, ("zip_code_prefix",), "geolocation"),
    "int_orders_enriched": _stored(
        "intermediate",
        intermediate.orders_enriched,
        ("order_id",),
        ByKey("stg_orders"),
        ByKey("stg_customers"),
        ByKey("stg_order_items"),
        ByKey("stg_order_payments"),
        ByKey("stg_order_reviews"),
    ),
    "int_seller_performance": _stored(
        "intermediate",
        intermediate.seller_performance,
        ("seller_id",),
        "stg_sellers",
        ByKey("stg_order_items"),
        ByKey("int_orders_enriched"),
    ),
    "int_product_performance": _stored(
        "intermediate",
        intermediate.product_performance,
        ("product_id",),
        "stg_products",
        ByKey("stg_order_items"),
        ByKey("int_orders_enriched"),
    ),
    "int_customer_history": _stored(
        "intermediate",
        intermediate.customer_history,
        ("customer_unique_id",),
        ByKey("int_orders_enriched"),
        ByKey("stg_order_payments"),
    ),
    "int_seller_status_history": _stored(
        "intermediate",
        seller_history.seller_status_history,
        ("scd_id",),
        "stg_sellers",
        ByKey("stg_order_items"),
        ByKey("stg_orders"),
    ),
    "mart_monthly_revenue": Table(
        "mart",
        lambda w: monthly.monthly_revenue(*w.month_states()),
        ("month_start",),
        inputs=(_MONTHLY,),
        **_VIEW,
    ),
    "mart_state_performance": Table(
        "mart",
        lambda w: monthly.state_performance(*w.month_states()),
        ("customer_state",),
        inputs=(_MONTHLY,),
        **_VIEW,
    ),
    "mart_product_category_analysis": _stored(
        "mart",
        marts.product_category_analysis,
        ("product_category",),
        ByKey("stg_order_items"),
        "stg_products",
        ByKey("int_orders_enriched"),
        **_VIEW,
    ),
    "mart_seller_scorecard": _stored(
        "mart", marts.seller_scorecard, ("seller_id",), "int_seller_performance", checked=False
    ),
    "mart_customer_segments": _stored(
        "mart",
        marts.customer_segments,
        ("customer_unique_id",),
        "int_customer_history",
        "stg_orders",
        **_VIEW,
    ),
}

#: Tables in build order; those of one step only read tables of earlier steps.
BUILD_STEPS: tuple[tuple[str, ...], ...] = (
    tuple(name for name, spec in TABLES.items() if spec.layer == "staging"),
    ("int_orders_enriched", "int_seller_status_history"),
    ("int_seller_performance", "int_product_performance", "int_customer_history"),
    tuple(name for name, spec in TABLES.items() if spec.layer == "mart"),
)
