"""Joins of lists, details, plans, logs and catalog rows. Fuzzy matches are unions of equi-joins, never cross joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions.status import COMPLETED
from corvane.operators.ordering import first_wins


def lookup(rows: DataFrame, pairs: DataFrame, key: str, value: str) -> DataFrame:
    """Rows with the first name listed for their code, null if none is."""
    return rows.join(first_wins(pairs, [key]).select(key, value), key, "left")


def drill_down(products: DataFrame, details: DataFrame, keys: list[str]) -> DataFrame:
    """Products with each of their periods."""
    return products.join(details, keys)


def zipped(rows: DataFrame, left: str, right: str, fill: str = "") -> DataFrame:
    """Two lists of a row side by side, the shorter one filled up: ``pos, left, right`` for each place."""
    pairs = F.arrays_zip(F.col(left).alias("_l"), F.col(right).alias("_r"))
    told = rows.select(*[c for c in rows.columns if c not in (left, right)], F.posexplode_outer(pairs).alias("pos", "_p"))
    return told.select("*", F.coalesce("_p._l", F.lit(fill)).alias(left), F.coalesce("_p._r", F.lit(fill)).alias(right)).drop("_p")


def best_detail(versions: DataFrame, details: DataFrame, key: str, start: str = "sale_start_date") -> DataFrame:
    """Each version with the detail row of its start date, else the first one; without any, with nulls."""
    own = details.withColumnRenamed(start, "_start")
    fields = [c for c in own.columns if c != key]
    joined = versions.join(own, key, "left")
    rank = F.struct(~F.coalesce(F.col("_start") == F.col(start), F.lit(False)), F.col("pos"))
    kept = joined.groupBy(*versions.columns).agg(F.min_by(F.struct(*fields), rank).alias("_d"))
    return kept.select(*versions.columns, *[F.col(f"_d.{c}").alias("detail_start_date" if c == "_start" else c) for c in fields])


def unfinished(products: DataFrame, checkpoints: DataFrame, active: DataFrame, key: str) -> DataFrame:
    """Products without a completed checkpoint, and those that are on sale, which have to be read again."""
    done = checkpoints.where("status = 'completed'").select(key).distinct()
    again = active.select(key).distinct()
    return products.join(done.join(again, key, "left_anti"), key, "left_anti")


def pending_items(plan: DataFrame, state: DataFrame, files: DataFrame) -> DataFrame:
    """Plan items that aren't completed or whose file is missing. ``files(saved_relative_path)`` lists what is stored."""
    latest = state.select("plan_key", "download_status", "saved_relative_path")
    there = files.select("saved_relative_path").distinct().withColumn("_there", F.lit(True))
    joined = plan.join(latest, "plan_key", "left").join(there, "saved_relative_path", "left")
    done = F.col("download_status").isin(*COMPLETED) & F.coalesce(F.col("_there"), F.lit(False))
    return joined.where(~F.coalesce(done, F.lit(False))).drop("_there")


def orphans(state: DataFrame, plan: DataFrame) -> DataFrame:
    """State rows without a plan item of the same key and identity; a run must stop if there are any."""
    return state.join(plan.select("plan_key", "dedupe_key"), ["plan_key", "dedupe_key"], "left_anti")


def pending_events(events: DataFrame, acked: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Events that are neither done nor set aside."""
    return events.join(acked.select("event_id").union(quarantined.select("event_id")), "event_id", "left_anti")


def match_versions(versions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Versions with the catalog rows they are: ``v`` and ``r`` structs.

    Both have ``company_code, source_product_id, name, sale_start, target`` (texts; empty is null). With ids on both sides ids and
    starts must be equal (or both starts missing); else names, and starts if both have one, else targets.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        columns = ("source_product_id", "name", "sale_start", "target")
        filled = df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in columns}).withColumn("company_code", F.upper(F.trim("company_code")))
        return filled.select(F.col("company_code"), *[F.col(c).alias(f"{name}_{c}") for c in columns], F.struct(*[F.col(c) for c in df.columns]).alias(name))

    v, r = side(versions, "v"), side(catalog, "r")
    start = F.coalesce(F.col("v_sale_start"), F.lit("")) == F.coalesce(F.col("r_sale_start"), F.lit(""))
    ids = F.col("v_source_product_id") == F.col("r_source_product_id")
    company = v.company_code == r.company_code
    one_id_missing = F.col("v_source_product_id").isNull() | F.col("r_source_product_id").isNull()
    one_start_missing = F.col("v_sale_start").isNull() | F.col("r_sale_start").isNull()
    names = company & (F.col("v_name") == F.col("r_name")) & one_id_missing
    by_id = v.join(r, company & ids & start)
    by_start = v.join(r, names & (F.col("v_sale_start") == F.col("r_sale_start")))
    by_target = v.join(r, names & (F.col("v_target") == F.col("r_target")) & one_start_missing)
    return by_id.select("v", "r").union(by_start.select("v", "r")).union(by_target.select("v", "r"))


def match_counts(versions: DataFrame, catalog: DataFrame) -> DataFrame:
    """How many pairs ``match_versions`` gives for each ``company_code`` (trimmed, upper case), told from the sizes of groups without making pairs.

    Of a group of one company, name and start, all pairs match but those with two ids; of one of company, name and target, of these those that
    have a start on one side only, or on none.
    """

    def side(df: DataFrame, ours: bool) -> DataFrame:
        c = {c: F.nullif(F.col(c), F.lit("")) for c in ("source_product_id", "name", "sale_start", "target")}
        by_id = F.struct(F.lit("id").alias("way"), c["source_product_id"].alias("value"), F.coalesce(c["sale_start"], F.lit("")).alias("day"))
        by_start = F.struct(F.lit("start").alias("way"), c["name"].alias("value"), c["sale_start"].alias("day"))
        by_target = F.struct(F.lit("target").alias("way"), c["name"].alias("value"), c["target"].alias("day"))
        ways = F.filter(F.array(by_id, by_start, by_target), lambda w: w["value"].isNotNull() & w["day"].isNotNull())
        told = df.select(F.upper(F.trim("company_code")).alias("company_code"), c["source_product_id"].isNotNull().alias("known"), c["sale_start"].isNotNull().alias("dated"), F.explode(ways).alias("w"))
        return told.where("company_code is not null").select("company_code", "w.*", "known", "dated", F.lit(ours).alias("ours"))

    def size(ours: bool, *flags: str):
        test = F.col("ours") == F.lit(ours)
        for flag in flags:
            test = test & F.col(flag)
        return F.count_if(test)

    kinds = {"n": (), "i": ("known",), "d": ("dated",), "id": ("known", "dated")}
    sizes = [size(ours, *flags).alias(f"{name}_{kind}") for name, ours in (("v", True), ("r", False)) for kind, flags in kinds.items()]
    groups = side(versions, True).union(side(catalog, False)).groupBy("company_code", "way", "value", "day").agg(*sizes)
    pairs = {kind: F.col(f"v_{kind}") * F.col(f"r_{kind}") for kind in kinds}
    one_id_missing = pairs["n"] - pairs["i"]
    matches = F.when(F.col("way") == "id", pairs["n"]).when(F.col("way") == "start", one_id_missing).otherwise(one_id_missing - (pairs["d"] - pairs["id"]))
    return groups.groupBy("company_code").agg(F.sum(matches).alias("matches")).where("matches > 0")


def matches_active(rows: DataFrame, active: DataFrame) -> DataFrame:
    """List rows, once each, that any active row could be, dates being compared only where both have one.

    Both sides have ``company_code, source_product_id, name, sale_start``. The active side is reduced to one row for each id and each name of a company,
    with the days on which it starts, so that many active rows of one name aren't met one by one.
    """
    told = active.select("company_code", *[F.nullif(c, F.lit("")).alias(f"_{c}") for c in ("source_product_id", "name", "sale_start")])
    idless = F.col("_source_product_id").isNull()
    dateless = F.col("_sale_start").isNull()

    def days(which=None):
        day, none = ("_sale_start", dateless) if which is None else (F.when(which, F.col("_sale_start")), dateless & which)
        seen = F.bool_or(F.lit(True) if which is None else which)
        return F.struct(F.collect_set(day).alias("days"), F.bool_or(none).alias("undated"), seen.alias("seen"))

    def met(own):
        day = F.nullif(F.col("sale_start"), F.lit(""))
        return F.coalesce(own["seen"] & (day.isNull() | own["undated"] | F.array_contains(own["days"], F.coalesce(day, F.lit("")))), F.lit(False))

    keyed = rows.distinct()
    for column, sets in (("source_product_id", {"_by_id": days()}), ("name", {"_by_name": days(), "_by_idless": days(idless)})):
        offered = told.where(F.col(f"_{column}").isNotNull()).groupBy(F.col("company_code").alias("_company"), F.col(f"_{column}").alias("_value")).agg(*[x.alias(n) for n, x in sets.items()])
        keyed = keyed.join(offered, (F.col("company_code") == F.col("_company")) & (F.col(column) == F.col("_value")), "left").drop("_company", "_value")
    own_id = F.nullif(F.col("source_product_id"), F.lit(""))
    named = F.when(own_id.isNull(), met(F.col("_by_name"))).otherwise(met(F.col("_by_idless")))
    return keyed.where(met(F.col("_by_id")) | named).select(*rows.columns)


def redirected(records: DataFrame, catalog: DataFrame, keys: list[str]) -> DataFrame:
    """Records with the one catalog row that is the same document at another address; not if there are several.

    Labels and file names must agree where both have one; catalog rows made by a plan don't count.
    """
    other = catalog.where(F.coalesce("checkpoint_key", F.lit("")) == "").select(
        *keys, F.col("document_key").alias("known_key"), F.col("document_url").alias("_url"), F.col("document_label").alias("_label"), F.col("original_filename").alias("_file")
    )
    agree = lambda a, b: (F.coalesce(F.col(a), F.lit("")) == "") | (F.coalesce(F.col(b), F.lit("")) == "") | (F.col(a) == F.col(b))
    met = records.join(other, keys).where((F.col("document_url") != F.col("_url")) & agree("document_label", "_label") & agree("original_filename", "_file"))
    alone = met.groupBy("record_id").agg(F.count("*").alias("_n"), F.min("known_key").alias("known_key")).where("_n = 1")
    return records.join(alone.select("record_id", "known_key"), "record_id")


def registry_gaps(catalog: DataFrame, registry: DataFrame) -> DataFrame:
    """Codes that only one side knows: ``code, side`` (MISSING in the registry, or EXTRA there)."""
    missing = catalog.select("code").join(registry.select("code"), "code", "left_anti").distinct().withColumn("side", F.lit("MISSING"))
    extra = registry.select("code").join(catalog.select("code"), "code", "left_anti").distinct().withColumn("side", F.lit("EXTRA"))
    return missing.union(extra)


def union_tabs(tabs: dict[str, DataFrame]) -> DataFrame:
    """Tabs of a list as one table, with the state that each tab stands for."""
    parts = [df.withColumn("tab_status", F.lit(name)) for name, df in tabs.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def missing_values(have: DataFrame, required: DataFrame, column: str) -> DataFrame:
    """Required values that are not there, once each."""
    return required.select(column).distinct().join(have.select(column), column, "left_anti")


def multiset_difference(left: DataFrame, right: DataFrame, keys: list[str], token: str) -> DataFrame:
    """Tokens that occur more often on one side: ``missing`` (left only) and ``added`` (right only) of each key and token."""
    return net_difference(left.select(*keys, token, F.lit(1).alias("_n")).union(right.select(*keys, token, F.lit(-1))), keys, token, "_n")


def net_difference(tokens: DataFrame, keys: list[str], token: str, sign: str) -> DataFrame:
    """The same of tokens of both sides together, 1 for each of the left and -1 for each of the right: one grouping and no join."""
    net = tokens.groupBy(*keys, token).agg(F.sum(sign).alias("_net")).where("_net <> 0")
    return net.select(*keys, token, F.greatest("_net", F.lit(0)).alias("missing"), F.greatest(-F.col("_net"), F.lit(0)).alias("added"))
