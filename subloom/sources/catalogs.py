"""Tables whose columns go by several names, and lists that must not contradict themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subloom.functions import texts as T
from subloom.functions.timecodes import clock_seconds

#: The names under which the columns of a table of turns are found, the first one that is there counting.
TURN_NAMES = {"speaker": ("speaker", "speaker_label"), "start": ("start_seconds", "start"), "end": ("end_seconds", "end")}


def under_names(df: DataFrame, names: dict[str, tuple[str, ...]], keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` and each wanted column from the first of its names that the table has; one with none is an error."""
    found = {want: next((n for n in own if n in df.columns), None) for want, own in names.items()}
    missing = [" or ".join(names[want]) for want, n in found.items() if n is None]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*keep, *[F.col(f"`{n}`").alias(want) for want, n in found.items()])


def turn_rows(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep…, speaker, start_ms, end_ms) of a table of turns; rows without a speaker or whose end isn't after the start are left out."""
    rows = under_names(df, TURN_NAMES, keep)
    ms = lambda c: F.round(clock_seconds(F.col(c).cast("string")) * 1000).cast("bigint")
    out = rows.select(*keep, T.strip(F.col("speaker")).alias("speaker"), ms("start").alias("start_ms"), ms("end").alias("end_ms"))
    return out.where((F.col("speaker") != "") & (F.col("end_ms") > F.col("start_ms")))


def role_names(df: DataFrame, column: str, generic: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """((form, role), (form, roles)): the names of a list by their normal form, and the forms under which it has several names, which are in neither list twice.

    Blank and null names don't count. The names of ``generic`` (one column) are added where the list has none of their form.
    """
    named = df.select(T.strip(F.col(column)).alias("role")).where("role <> ''").distinct().withColumn("form", T.name_form(F.col("role")))
    forms = named.groupBy("form").agg(F.count("*").alias("_n"), F.min("role").alias("role"), F.array_sort(F.collect_list("role")).alias("roles"))  # spellings of one name
    known = forms.where("_n = 1").select("form", "role")
    if generic is not None:
        more = generic.select(F.col(generic.columns[0]).alias("role")).where("role is not null").distinct().withColumn("form", T.name_form(F.col("role")))
        known = known.unionByName(more.join(forms.select("form"), "form", "left_anti").groupBy("form").agg(F.min("role").alias("role")))
    return known, forms.where("_n > 1").select("form", "roles")


def manifest_faults(df: DataFrame, episode: str, required: list[str]) -> DataFrame:
    """(episode, fault) of a list of episodes: ``not_four_digits``, ``duplicate`` or ``missing_<column>`` for a required column that is blank; an episode can have several."""
    rows = df.select(F.col(episode).alias("episode"), *[F.col(c) for c in required])
    blank = [F.max((F.coalesce(T.strip(F.col(c).cast("string")), F.lit("")) == "").cast("int")).alias(f"_m_{c}") for c in required]
    each = rows.groupBy("episode").agg(F.count("*").alias("_n"), *blank)
    faults = [F.when(~F.coalesce(F.col("episode").rlike(r"^[0-9]{4}\z"), F.lit(False)), "not_four_digits"), F.when(F.col("_n") > 1, "duplicate"), *[F.when(F.col(f"_m_{c}") == 1, f"missing_{c}") for c in required]]
    return each.select("episode", F.explode(F.array_compact(F.array(*faults))).alias("fault"))


def cue_ids(df: DataFrame) -> DataFrame:
    """(cue_id) of a table that has it, or has ``source_index`` instead, as text without blanks at its ends; blank ones are left out."""
    ids = under_names(df, {"cue_id": ("cue_id", "source_index")})
    return ids.select(T.strip(F.col("cue_id").cast("string")).alias("cue_id")).where("cue_id <> ''")
