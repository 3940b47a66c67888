"""Job settings: one row of a config table, or one JSON object, per job."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.canonical import TextRules
from ..operators.cells import FAMILY
from ..names import bind
from ..operators.windows import CursorWindow

# Config column of each setting of a keyed export.
EXPORT_COLUMNS = {
    "config_id": "id",
    "source": "hive_tbname",
    "keys": "rowkey",
    "target": "hbase_tbname",
    "label": "trsdr_sjly",
    "columns": "hive_columns",
    "target_columns": "hbase_columns",
    "cursor_column": "hive_columns_cjsj",
    "cursor": "hive_columns_cjsj_lasttime",
    "cursor_add_time": "hive_columns_cjsj_add_time",
    "id_columns": "sfzhm_columns",
    "step_days": "time_step_num",
    "cursor_type": "hive_columns_cjsj_type",
}
# Config column of each setting of a relational append.
APPEND_COLUMNS = {
    "source": "hive_tbname",
    "columns": "hive_columns",
    "cursor_column": "hive_columns_cjsj",
    "cursor": "hive_columns_cjsj_lasttime",
    "cursor_type": "hive_columns_cjsj_type",
    "target": "oracle_tbname",
    "label": "trsdr_sjly",
}


@dataclass(frozen=True)
class JobSpec:
    """Settings of one job. Blank texts mean "not set".

    ``label``, ``target_columns`` and ``cursor_add_time`` are carried along and not used.
    """

    source: str
    target: str = ""
    keys: str = ""
    columns: str = "*"
    cursor_column: str = ""
    cursor: str = ""
    cursor_type: str = ""
    step_days: str = ""
    id_columns: str = ""
    config_id: str = ""
    label: str = ""
    target_columns: str = ""
    cursor_add_time: str = ""
    # choices that a config row does not hold
    date_mode: str = "parse"
    policy: str = "advance"
    upper_case: bool = False
    # a partition column that holds the day of the cursor column
    day_column: str = ""

    @classmethod
    def from_row(cls, row: Mapping[str, Any], columns: Mapping[str, str] = EXPORT_COLUMNS, **choices: Any) -> JobSpec:
        """A config row whose column names may be in any case."""
        given = {k.lower(): v for k, v in row.items()}
        texts = {name: given.get(column) for name, column in columns.items()}
        settings = {name: str(value).strip() for name, value in texts.items() if value is not None}
        return cls(**settings, **choices)

    def window(self, inclusive: bool = True) -> CursorWindow:
        return CursorWindow.of(self.cursor, self.step_days, inclusive)

    def rules(self) -> TextRules:
        ids = tuple(c.strip() for c in self.id_columns.split(",") if c.strip())
        return TextRules(date_mode=self.date_mode, id_columns=ids)

    def family(self) -> str:
        return FAMILY.upper() if self.upper_case else FAMILY

    def at(self, cursor: str) -> JobSpec:
        """The same job from another cursor."""
        return replace(self, cursor=cursor)


def with_cursors(configs: DataFrame, cursors: DataFrame, columns: Mapping[str, str] = EXPORT_COLUMNS) -> DataFrame:
    """Config rows with the cursor that their last run saved; the config's own where there is none."""
    config_id, cursor = bind(configs, columns["config_id"]), bind(configs, columns["cursor"])
    last = cursors.select(F.col("config_id").alias("__config_id"), F.col("cursor").alias("__cursor"))
    joined = configs.join(last, F.col(f"`{config_id}`").cast("string") == F.col("__config_id"), "left")
    now = F.coalesce("__cursor", F.col(f"`{cursor}`").cast("string")).alias(cursor)
    return joined.select(*[now if c == cursor else F.col(f"`{c}`") for c in configs.columns])


def specs_from(
    configs: DataFrame,
    columns: Mapping[str, str] = EXPORT_COLUMNS,
    cursors: DataFrame | None = None,
    **choices: Any,
) -> Iterator[JobSpec]:
    """Jobs of a config table, fetched a partition at a time.

    ``cursors`` (:meth:`cellferry.plans.runlog.CursorTable.current`) says where each job stopped.
    """
    if cursors is not None:
        configs = with_cursors(configs, cursors, columns)
    for row in configs.toLocalIterator():
        yield JobSpec.from_row(row.asDict(), columns, **choices)


def json_schema(columns: Mapping[str, str] = APPEND_COLUMNS) -> T.StructType:
    """All settings as text."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns.values()])


def to_config_json(configs: DataFrame) -> Column:
    """A config row as one JSON object; settings that are null are left out."""
    return F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in configs.columns]))


def from_config_json(text: Column, columns: Mapping[str, str] = APPEND_COLUMNS) -> Column:
    """A JSON object as a struct of settings; null where the text is no JSON."""
    return F.from_json(text, json_schema(columns))

