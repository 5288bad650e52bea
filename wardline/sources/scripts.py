"""Mapping and settings tables that sites keep as scripts of INSERT statements.

A script is read line by line, so a large file is split among tasks.  A line holds one
statement, ``insert into t (a, b) values ('x', 1), ('y', null);``, a comment (``--`` or
``REM``), one of the commands that a loader needs (``commit``, ``set ...``), or nothing.
Quoted values may hold commas, brackets, semicolons and doubled quotes.  Parsing is done
by built-in functions.  A line that is none of these fails the job that reads it, and so
does a value that is not of its column's type, or a column that the table does not have.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.config import SiteConfig
from wardline.sources import schemas
from wardline.sources.maps import Maps

# Possessive, so that a long value neither backtracks nor nests calls.
_QUOTED = "'[^']*+(?:''[^']*+)*+'"
_BARE = r"(?i:null|[-+]?(?:\d++\.?\d*+|\.\d++)(?:e[-+]?\d++)?)"
_VALUE = rf"\s*+(?:{_QUOTED}|{_BARE})\s*+"
_ROW = rf"\({_VALUE}(?:,{_VALUE})*+\)"
_STATEMENT = rf"^\s*+(?i:insert\s++into)\s++([\w.$#]++)\s*+\(([\w\s,$#]++)\)\s*+(?i:values)\s*+({_ROW}(?:\s*+,\s*+{_ROW})*+)\s*+;?\s*+$"
_OTHER = r"^\s*+(?:--.*|(?i:rem(?:\s.*)?|commit\s*;?|set\s+[\w\s]+;?))?\s*+$"


def _plain(value: Column) -> Column:
    """A value's text: quotes taken off, null for ``null``."""
    bare = F.trim(value)
    unquoted = F.replace(F.substr(bare, F.lit(2), F.length(bare) - 2), F.lit("''"), F.lit("'"))
    return F.when(bare.startswith("'"), unquoted).when(F.lower(bare) != "null", bare)


def read_inserts(spark: SparkSession, path: str, table: str, schema: T.StructType) -> DataFrame:
    """The rows that a script (a file or a folder of them) inserts into ``table``, typed by ``schema``.

    Names of tables and columns are compared without case; a schema in front of the table's
    name is ignored.  Columns that a statement leaves out are null.  Statements for other
    tables are checked and left out.
    """
    line = F.regexp_replace("value", r"\r$", "")
    understood = line.rlike(_STATEMENT) | line.rlike(_OTHER)
    checked = F.when(understood, line).otherwise(F.raise_error(F.concat(F.lit("not an INSERT statement: "), F.left(line, F.lit(200)))))
    statements = spark.read.text(path).select(checked.alias("line")).filter(F.col("line").rlike(_STATEMENT))

    def part(k: int) -> Column:
        return F.regexp_extract("line", _STATEMENT, k)

    name = F.lower(F.element_at(F.split(part(1), r"\."), -1))
    names = F.transform(F.split(F.lower(part(2)), ","), lambda c: F.trim(c))
    rows = F.regexp_extract_all(part(3), F.lit(f"({_ROW})"), F.lit(1))
    held = statements.filter(name == table.lower()).select("line", names.alias("names"), F.explode(rows).alias("row"))
    values = F.transform(F.regexp_extract_all("row", F.lit(f"({_QUOTED}|{_BARE})"), F.lit(1)), _plain)
    known = [f.name.lower() for f in schema]
    fits = (F.size("names") == F.size("values")) & (F.size(F.array_except("names", F.array(*map(F.lit, known)))) == 0)
    fits = fits & (F.size(F.array_distinct("names")) == F.size("names"))
    wrong = F.raise_error(F.concat(F.lit(f"does not fit the columns of {table}: "), F.left("line", F.lit(200))))
    cells = F.when(fits, F.map_from_arrays("names", "values")).otherwise(wrong)
    typed = held.withColumn("values", values).select(cells.alias("cells"))
    return typed.select(*(F.col("cells")[f.name.lower()].cast(f.dataType).alias(f.name) for f in schema))


def read_map_script(
    spark: SparkSession, path: str, code_map: str = "covid_code_map", lab_map: str = "covid_lab_map", med_map: str = "covid_med_map"
) -> Maps:
    """A site's three maps from one script, without repeated rows; the names are those of its tables."""
    return Maps(
        read_inserts(spark, path, code_map, schemas.CODE_MAP).distinct(),
        read_inserts(spark, path, lab_map, schemas.LAB_MAP).distinct(),
        read_inserts(spark, path, med_map, schemas.MED_MAP).distinct(),
    )


def read_config_script(spark: SparkSession, path: str, as_of: date, table: str = "covid_config", **choices) -> SiteConfig:
    """A site's settings from a script that inserts its one row."""
    return SiteConfig.from_table(read_inserts(spark, path, table, schemas.CONFIG), as_of, **choices)
