"""Many runs at once: their parameters with their provenance, their folders and their links, as rows of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.config import RUN_DEFAULTS


def _set(value: Column) -> Column:
    """A value that counts as set: zero, "0.0", "" and null fall through."""
    return value.isNotNull() & (value != "") & F.coalesce(value.try_cast("double") != 0, F.lit(True))


def parameters(asked: DataFrame) -> DataFrame:
    """(run_id, name, value, source) of each run and parameter, from ``asked(run_id, via, name, given, configured)`` of
    strings: as ``config.resolve`` does for one run. What is given wins, then the settings file, then the default; zero and
    empty values fall through, but a given target size counts even if it is zero. Names without a row have their default,
    other names than a run's parameters are left aside. Rows are taken as they come; what is grouped is a number for each
    run, whose bits tell the names that have a row."""
    presets = {n: (F.lit(None if v is None else str(v)).cast("string"), F.lit(1 << i)) for i, (n, v) in enumerate(RUN_DEFAULTS.items())}
    known = F.col("run_id").isNotNull() & F.col("name").isin(*presets)
    preset, bit = (F.coalesce(*(F.when(F.col("name") == n, v[k]) for n, v in presets.items())) for k in (0, 1))
    present = asked.where(known).withColumn("preset", preset)
    every = F.array(*(F.struct(F.lit(n).alias("name"), p.alias("preset"), b.alias("bit")) for n, (p, b) in presets.items()))
    seen = asked.groupBy("run_id").agg(F.bit_or(F.when(known, bit).otherwise(0)).alias("seen"))
    absent = seen.select("run_id", "seen", F.inline(every)).where(F.col("seen").bitwiseAND(F.col("bit")) == 0)
    rows = present.unionByName(absent.drop("seen", "bit"), allowMissingColumns=True)
    exact = F.col("name") == "target_size"
    given = F.coalesce(_set(F.col("given")) | exact & F.col("given").isNotNull() & (F.col("given") != ""), F.lit(False))
    configured = F.coalesce(_set(F.col("configured")) | exact & F.col("configured").isNotNull() & (F.col("configured") != ""), F.lit(False))
    value = F.when(given, F.col("given")).when(configured, F.col("configured")).otherwise(F.col("preset"))
    source = F.when(given, F.col("via")).when(configured, F.lit("config")).otherwise(F.lit("default"))
    return rows.select("run_id", "name", value.alias("value"), source.alias("source"))


def output_folder(source: Column, root: str = "data/output") -> Column:
    """The folder of a run that names none: its source's last part without its last extension, below ``root``."""
    name = F.regexp_extract(F.rtrim(source, F.lit("/")), "[^/]*$", 0)
    return F.concat(F.lit(f"{root}/"), F.when(F.rlike(name, F.lit(r"^[^.].*\.[^.]*$|^\..*[^.]\.[^.]*$")), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name))


def link(path: Column, root: Column) -> Column:
    """An image's path relative to the folder that is served, empty outside of it; steps up are never followed."""
    top = F.concat(F.rtrim(root, F.lit("/")), F.lit("/"))
    below = F.startswith(path, top) & ~F.rlike(path, F.lit(r"(^|/)\.\.(/|$)"))
    return F.when(below, F.substr(path, F.length(top) + 1)).otherwise(F.lit(""))
