"""Catalog changes as set operations: create, partial update, update by body, documentation
replace, delete, KPI match and upsert, and the ordered change fold (M8).

Records are rows of a keyed table whose other columns are the record's fields. A change payload
is a JSON object; a field counts as supplied when its *key is present*, so an explicit JSON null
overrides while an absent key keeps the current value.

Scale notes. Everything here is joins on the record key plus grouped aggregations. The fold
picks each field's winner with ``max(struct(seq, value))``, an aggregate with a map-side partial
step (Spark runs min/max over structs as sort-based aggregation, which spills rather than fails),
so a key that holds a third of all changes is reduced before the shuffle instead of landing whole
in one task. The only ordered per-key step, finding the last create/delete before each update for
the reject list, runs on seq buckets (``carry_last``) so a hot key is split across tasks.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vantage.functions.expressions import kpi_id

RESET_OPS = ("create", "delete")
OPS = (*RESET_OPS, "update")


def _field_schema(state: DataFrame, key: str) -> StructType:
    return StructType([f for f in state.schema.fields if f.name != key])


_UNREAD = "_unread"


def _parsed(changes: DataFrame, fields: StructType, payload: str = "payload") -> DataFrame:
    """Adds ``_keys`` (payload object keys), ``_val`` (payload parsed to the field types; its ``_unread`` field
    holds the text if any value could not be read) and ``_fault``. Nothing parses the payload again: faults
    are conditions on these columns, not filters, which Catalyst would move below the parse."""
    kept = StructType([*fields.fields, StructField(_UNREAD, StringType())])
    parsed = changes.withColumns({
        "_keys": F.json_object_keys(F.col(payload)),
        "_val": F.from_json(F.col(payload), kept, {"columnNameOfCorruptRecord": _UNREAD}),
    })
    return parsed.withColumn("_fault", change_fault(payload))


def change_fault(payload: str = "payload") -> Column:
    """Why a parsed change (``_parsed``) cannot be applied: ``bad payload`` (not a JSON object),
    ``bad value`` (a supplied value that its field's type cannot hold), or NULL. A NULL payload
    supplies no fields."""
    return (F.when(F.col(payload).isNotNull() & F.col("_keys").isNull(), F.lit("bad payload"))
            .when(F.col(f"_val.{_UNREAD}").isNotNull(), F.lit("bad value")))


# -- M1 create ------------------------------------------------------------------------------------

def create(state: DataFrame, new: DataFrame, key: list[str] | str) -> tuple[DataFrame, DataFrame]:
    """M1: add records whose key does not exist yet. Returns ``(state ∪ accepted, rejects)``;
    a key already present, or repeated inside the batch after its first occurrence (by ``seq``
    when present, then by the other columns), is rejected, and so is a row with a NULL in its key.
    Rows identical in every column are one record."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = state.columns
    others = [c for c in new.columns if c not in keys]
    # the first row of a key is the one with the lowest seq; without a seq column, the smallest
    # row (rows identical in every column are one record and are created once)
    if "seq" in new.columns:
        order = F.struct("seq", *[c for c in others if c != "seq"])
    elif others:
        order = F.struct(*others)
    else:
        order = F.lit(0)
    tagged = new.withColumn("_ord", order)
    first = (tagged.groupBy(*keys).agg(F.min("_ord").alias("_ord")))
    firsts = tagged.join(first, keys + ["_ord"], "left_semi").dropDuplicates(keys + ["_ord"])
    dup = tagged.join(first, keys + ["_ord"], "left_anti").withColumn(
        "reason", F.when(reduce(or_, [F.col(k).isNull() for k in keys]), F.lit("null key"))
        .otherwise(F.lit("duplicate in batch")))
    exists = firsts.join(state.select(*keys), keys, "left_semi").withColumn("reason", F.lit("exists"))
    accepted = firsts.join(state.select(*keys), keys, "left_anti")
    rejects = dup.unionByName(exists).drop("_ord")
    return state.unionByName(accepted.select(*cols)), rejects


# -- M2 / M3 / M4 updates -----------------------------------------------------------------------

def partial_update(state: DataFrame, updates: DataFrame, key: str = "key",
                   payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """M2: merge payload fields over the current record (several updates per key apply in ``seq``
    order). Updates of absent keys are rejected. Returns ``(new state, rejects)``."""
    ups = updates if "seq" in updates.columns else updates.withColumn("seq", F.lit(0).cast("bigint"))
    ups = ups.withColumn("op", F.lit("update"))
    return apply_changes(state, ups.select(key, "seq", "op", payload), key=key, payload=payload)


def latest_per_key(df: DataFrame, key: str, value_cols: list[str]) -> DataFrame:
    """One row per key: the latest by ``seq`` when there is a seq column, else the greatest value.
    A grouped ``max`` over structs, so duplicates of a hot key are reduced map-side."""
    order = [F.col("seq")] if "seq" in df.columns else []
    packed = F.max(F.struct(*order, *[F.col(c) for c in value_cols])).alias("_l")
    return df.groupBy(key).agg(packed).select(key, *[F.col(f"_l.{c}").alias(c) for c in value_cols])


def update_body(state: DataFrame, bodies: DataFrame, key: str = "key", payload: str = "payload") -> DataFrame:
    """M3: the fields whose key the body holds are set (an explicit null too), the others keep their
    value. Keys without a current record are not created. Several bodies for one key: the latest
    (by ``seq``) wins. A body that is no JSON object, or holds a value its field cannot take,
    changes nothing; ``change_fault`` names those."""
    fields = _field_schema(state, key)
    bodies = latest_per_key(bodies, key, [payload])
    body = _parsed(bodies, fields, payload).select(key, F.when(F.col("_fault").isNull(), F.col("_keys")).alias("_keys"), "_val")
    updated = state.join(body, key, "left")
    return updated.select(key, *[
        F.when(F.array_contains("_keys", f.name), F.col(f"_val.{f.name}")).otherwise(F.col(f.name)).alias(f.name)
        for f in fields.fields])


def replace_field(state: DataFrame, values: DataFrame, field: str, key: str = "id") -> DataFrame:
    """M4: one field replaced (e.g. documentation); the others are kept. Several values for one
    key: the latest (by ``seq``) wins."""
    v = latest_per_key(values, key, [field]).select(F.col(key), F.col(field).alias("_new"), F.lit(True).alias("_has"))
    return (state.join(v, key, "left")
            .withColumn(field, F.when(F.col("_has"), F.col("_new")).otherwise(F.col(field)))
            .select(*state.columns))


def delete_keys(state: DataFrame, keys: DataFrame, key: list[str] | str = "id") -> DataFrame:
    """M5: drop records by key."""
    ks = [key] if isinstance(key, str) else list(key)
    return state.join(keys.select(*ks), ks, "left_anti").select(*state.columns)


# -- M7 nested entries -------------------------------------------------------------------------

# Defaults of a processing-register entry.
DPA_DEFAULT_STATUS = "inactive"
DPA_DEFAULT_TOGGLEABLE = True
DPA_KEY = ["solution_id", "slug"]


def dpa_entries_from(requests: DataFrame) -> DataFrame:
    """M7 create in bulk: flat requests → entries keyed (solution_id, slug) with an ``attributes``
    struct holding one amendment in ``activityAmendments``. Missing status is ``inactive``,
    missing toggleable is true. Deletes go through ``delete_keys`` like those of any keyed record."""
    amendment = F.struct(F.col("data_type").alias("dataType"), F.col("person_group").alias("personGroup"),
                         F.col("purpose").alias("purpose"), F.col("safety_measures").alias("safetyMeasures"))
    return requests.select(
        *DPA_KEY,
        F.coalesce(F.col("status"), F.lit(DPA_DEFAULT_STATUS)).alias("status"),
        F.coalesce(F.col("toggleable"), F.lit(DPA_DEFAULT_TOGGLEABLE)).alias("toggleable"),
        F.struct(F.col("data_processing_confirmed").alias("dataProcessingConfirmed"),
                 F.col("has_personal_data").alias("hasPersonalData"),
                 F.col("data_category").alias("dataCategory"),
                 F.array(amendment).alias("activityAmendments")).alias("attributes"),
    )


def dpa_update(state: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M7 update in bulk: a request replaces its entry's status, toggleable and attributes, missing ones by
    the defaults of a create. Several requests for one entry: the latest (by ``seq``) counts. Requests
    whose entry does not exist are rejected. Returns ``(new state, rejects)``."""
    fields = [c for c in requests.columns if c not in (*DPA_KEY, "seq")]
    latest = requests.groupBy(*DPA_KEY).agg(F.max(F.struct(*(["seq"] if "seq" in requests.columns else []), *fields)).alias("_l"))
    entries = dpa_entries_from(latest.select(*DPA_KEY, *[F.col(f"_l.{c}").alias(c) for c in fields]))
    new = entries.select(*DPA_KEY, F.struct("status", "toggleable", "attributes").alias("_new"))
    merged = state.join(new, DPA_KEY, "left").select(*[
        F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
        if c in ("status", "toggleable", "attributes") else F.col(c) for c in state.columns])
    rejects = requests.join(state.select(*DPA_KEY), DPA_KEY, "left_anti").select(*requests.columns)
    return merged, rejects.withColumn("reason", F.lit("absent entry"))


def merge_nested(state: DataFrame, changes: DataFrame, path: str, item_key: list[str],
                 key: list[str] | str = DPA_KEY) -> tuple[DataFrame, DataFrame]:
    """M7: items of an ``array<struct>`` replaced, added and removed by their own key, without exploding the array.

    ``path`` names the array: a column, or a field of a struct column (``attributes.activityAmendments``).
    ``changes``: the record's key, ``seq``, ``op`` (``set`` or ``remove``) and ``item``, a struct like the array's
    items whose ``item_key`` fields name the item (for ``remove`` only those matter). Of several changes of
    one item the one with the highest ``seq`` counts (at ties a set, then the greatest item). A set replaces the item where it stands, or adds it
    behind the others in the order of ``seq`` (then of their keys); should an array hold a key twice, the first is replaced and
    the others go. Other items keep their place, a NULL array counts as empty. A remove of what is not
    there does nothing. Changes of absent records and unknown operations are rejected.
    Returns ``(new state, rejects)``.

    Changes are reduced to one row per item before they are gathered per record, with a map-side partial
    step, so a record that gets a third of all changes costs its distinct items only.
    """
    keys = [key] if isinstance(key, str) else list(key)
    column, _, field = path.partition(".")
    known_op = F.coalesce(F.col("op").isin("set", "remove"), F.lit(False))

    def named(item: Column) -> Column:
        return F.struct(*[item[f].alias(f) for f in item_key])

    last = (changes.where(known_op).groupBy(*keys, named(F.col("item")).alias("_k"))
            .agg(F.max(F.struct("seq", "op", "item")).alias("_c")))
    per = last.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_c.seq", "_c.op", "_k", "_c.item"))).alias("_changes"))
    joined = state.join(per, keys, "left")
    array = F.col(path)
    joined = joined.withColumn("_items", F.coalesce(array, F.array().cast(joined.select(array).schema[0].dataType)))
    joined = joined.withColumn("_keys", F.transform("_items", named))
    items, item_keys, todo = F.col("_items"), F.col("_keys"), F.col("_changes")

    def change_of(item: Column) -> Column:
        return F.try_element_at(F.filter(todo, lambda c: c["_k"].eqNullSafe(named(item))), F.lit(1))

    pairs = F.transform(items, lambda item: F.struct(item.alias("item"), change_of(item).alias("c")))
    kept = F.filter(pairs, lambda p, i: p["c"].isNull() | ((p["c"]["op"] == "set") & (
        F.array_position(item_keys, named(p["item"])) == i + 1)))
    kept = F.transform(kept, lambda p: F.when(p["c"].isNull(), p["item"]).otherwise(p["c"]["item"]))
    added = F.filter(todo, lambda c: (c["op"] == "set") & ~F.array_contains(item_keys, c["_k"]))
    added = F.transform(added, lambda c: c["item"])
    merged = F.when(todo.isNull(), array).otherwise(F.concat(kept, added))
    if field:
        merged = F.when(todo.isNull(), F.col(column)).otherwise(F.col(column).withField(field, merged))
    out = joined.withColumn(column, merged).select(*state.columns)
    absent = (changes.where(known_op).join(state.select(*keys), keys, "left_anti").select(*changes.columns)
              .withColumn("reason", F.lit("absent record")))
    return out, absent.unionByName(changes.where(~known_op).withColumn("reason", F.lit("unknown op")))


# -- K1 / M6 KPI match and upsert ------------------------------------------------------------------

def kpi_match(insights: DataFrame, requests: DataFrame, order: Column | None = None) -> DataFrame:
    """K1: for each (solution_id, kpi_id) request the first listed insight whose name starts with
    that KPI id before the first " - "; ``insight_id`` is NULL when there is none (the error rows).

    Matching is an equi-join on the extracted KPI id; "first listed" is ``min(struct(order, id))``
    per (solution, KPI), an aggregate with a map-side partial step, so a KPI shared by a third of
    all insights is reduced before the shuffle.
    """
    order = order if order is not None else F.col("id")
    firsts = (insights.select("id", "solution_id", kpi_id(F.col("name")).alias("kpi_id"), order.alias("_o"))
              .groupBy("solution_id", "kpi_id").agg(F.min(F.struct("_o", "id")).alias("_m"))
              .select("solution_id", "kpi_id", F.col("_m.id").alias("insight_id")))
    return requests.join(firsts, ["solution_id", "kpi_id"], "left")


_KPI_KEY = ["solution_id", "kpi_id"]


def _latest_bodies(bodies: DataFrame, fields: list[str]) -> DataFrame:
    """One body per (solution, KPI): the latest by ``seq`` when there is one, ties and no seq by all fields."""
    order = ["seq"] if "seq" in bodies.columns else []
    return (bodies.groupBy(*_KPI_KEY).agg(F.max(F.struct(*order, *fields)).alias("_l"))
            .select(*_KPI_KEY, *[F.col(f"_l.{c}").alias(c) for c in fields]))


def _new_id(id_prefix: str) -> Column:
    return F.concat(F.lit(id_prefix + "-"), F.col("solution_id"), F.lit("-"), F.col("kpi_id"))


def upsert_by_kpi(insights: DataFrame, bodies: DataFrame, order: Column | None = None,
                  id_prefix: str = "new") -> DataFrame:
    """M6: what each (solution, KPI) of a batch of bodies (solution_id, kpi_id, name, …) does: it updates the
    KPI's match, or creates an insight when there is none. Unlike the original client, a failed update never turns into
    a duplicate create: matching decides, nothing else. Several bodies for one KPI are one upsert, the
    latest by ``seq``. Returns the upserted insights with ``action``; ``merge_by_kpi`` applies them."""
    matched = kpi_match(insights, _latest_bodies(bodies, ["name"]), order)
    return matched.select(
        F.coalesce(F.col("insight_id"), _new_id(id_prefix)).alias("id"), "solution_id", "name",
        F.when(F.col("insight_id").isNull(), F.lit("create")).otherwise(F.lit("update")).alias("action"))


def merge_by_kpi(insights: DataFrame, bodies: DataFrame, order: Column | None = None,
                 id_prefix: str = "new") -> tuple[DataFrame, DataFrame]:
    """M6 as one merge: the insight table after a batch of upserts, and the rejects.

    ``bodies``: solution_id, kpi_id, optionally ``seq``, and any fields of the insights. They are reduced to one
    per (solution, KPI), the latest; it sets its fields on the KPI's match and keeps the others, or becomes
    a new insight whose other fields are NULL. Matches are those of the table as it stood before the
    batch. The source then has one row per target id, and a full outer join merges it with the state.
    Rejected: bodies without solution or KPI (``null key``), and creates whose new id another insight
    already has (``id exists``), which stays as it was.
    """
    fields = [c for c in insights.columns if c in bodies.columns and c not in ("id", "solution_id")]
    keyed = F.col("solution_id").isNotNull() & F.col("kpi_id").isNotNull()
    matched = kpi_match(insights, _latest_bodies(bodies.where(keyed), fields), order)
    source = matched.select(
        F.coalesce(F.col("insight_id"), _new_id(id_prefix)).alias("id"),
        F.struct("solution_id", "kpi_id", F.col("insight_id").isNotNull().alias("update"), *fields).alias("_s"))
    both = insights.withColumn("_present", F.lit(True)).join(source, "id", "full")
    body, present = F.col("_s"), F.col("_present").isNotNull()
    applies = body.isNotNull() & (body["update"] | ~present)
    out = {"solution_id": F.coalesce(F.col("solution_id"), body["solution_id"])}
    for c in fields:
        out[c] = F.when(applies, body[c]).otherwise(F.col(c))
    state = both.select(*[out[c].alias(c) if c in out else F.col(c) for c in insights.columns])
    taken = both.where(present & body.isNotNull() & ~body["update"]).select(
        body["solution_id"].alias("solution_id"), body["kpi_id"].alias("kpi_id"), F.lit("id exists").alias("reason"))
    return state, taken.unionByName(bodies.where(~keyed).select(*_KPI_KEY, F.lit("null key").alias("reason")))


# -- M8 change fold -------------------------------------------------------------------------------

def carry_last(df: DataFrame, key: str, seq: str, marker: Column, values: tuple[str, str], out: str,
               bucket_width: int = 1 << 20) -> DataFrame:
    """Adds ``out``: the last non-null ``marker`` (one of two ``values``) strictly before each row within its key, in
    ``seq`` order. Rows are ordered inside (key, seq bucket) groups only; what earlier buckets
    end with comes from a one-row-per-bucket summary, so no task holds more than one bucket of
    one key, however hot the key. Rows are computed and dealt to their bucket once, for both uses."""
    dealt = df.withColumns({"_b": F.floor(F.col(seq) / F.lit(bucket_width)), "_mk": marker}).repartition(key, "_b")
    w_in = Window.partitionBy(key, "_b").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    within = dealt.withColumn("_within", F.last("_mk", ignorenulls=True).over(w_in))
    one, two = (F.max(F.when(F.col("_mk") == v, F.col(seq))) for v in values)
    per_bucket = dealt.groupBy(key, "_b").agg(one.alias("_one"), two.alias("_two"))
    last = F.when(F.coalesce(F.col("_two") >= F.col("_one"), F.col("_two").isNotNull()), F.lit(values[1])).when(
        F.col("_one").isNotNull(), F.lit(values[0]))
    w_b = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(key, "_b", F.last(last, ignorenulls=True).over(w_b).alias("_carry"))
    return (within.join(carry, [key, "_b"], "left")
            .withColumn(out, F.coalesce(F.col("_within"), F.col("_carry")))
            .drop("_b", "_mk", "_within", "_carry"))


def _checked(changes: DataFrame, fields: StructType, payload: str = "payload") -> DataFrame:
    """Parsed changes; ``_fault`` also names unknown operations, and a delete's payload does not matter."""
    fault = (F.when(F.col("op").isNull() | ~F.col("op").isin(*OPS), F.lit("unknown op"))
             .when(F.col("op") != "delete", F.col("_fault")))
    return _parsed(changes, fields, payload).withColumn("_fault", fault)


def fold_changes(changes: DataFrame, fields: StructType, key: str = "key", payload: str = "payload") -> DataFrame:
    """Per key: ``_reset`` = latest (seq, op) among create/delete, and per field ``_w_<f>`` =
    latest (seq, value) among non-delete changes whose payload has that key. Every column is a
    ``max`` of structs, so folds of separate batches merge exactly with ``merge_folds``. Faulty changes
    (``_fault``) have no effect."""
    parsed = _checked(changes, fields, payload)
    fine = F.col("_fault").isNull()
    is_reset = F.col("op").isin(*RESET_OPS) & fine
    aggs = [F.max(F.when(is_reset, F.struct(F.col("seq").alias("s"), F.col("op").alias("op")))).alias("_reset")]
    for f in fields.fields:
        aggs.append(F.max(F.when(fine & (F.col("op") != "delete") & F.array_contains("_keys", f.name),
                                 F.struct(F.col("seq").alias("s"), F.col(f"_val.{f.name}").alias("v"))))
                    .alias(f"_w_{f.name}"))
    return parsed.groupBy(key).agg(*aggs)


def merge_folds(a: DataFrame, b: DataFrame, key: str = "key") -> DataFrame:
    """Combine two folds (e.g. earlier micro-batches and a new one): the result equals folding the
    union of their changes, whatever order the batches arrived in."""
    cols = [c for c in a.columns if c != key]
    return a.unionByName(b).groupBy(key).agg(*[F.max(c).alias(c) for c in cols])


def finalize_fold(state: DataFrame, folded: DataFrame, key: str = "key") -> DataFrame:
    """Records after the folded changes: with no reset the current record is the base; after a
    create the record is rebuilt from the create and later changes; after a delete it is gone."""
    fields = _field_schema(state, key)
    joined = state.withColumn("_present", F.lit(True)).join(folded, key, "full")
    reset = F.col("_reset")
    keep = (reset.isNull() & F.col("_present")) | (reset.isNotNull() & (F.col("_reset.op") == "create"))
    out_cols = []
    for f in fields.fields:
        w = F.col(f"_w_{f.name}")
        since_reset = w.isNotNull() & (reset.isNull() | (F.col(f"_w_{f.name}.s") >= F.col("_reset.s")))
        base = F.when(reset.isNull(), F.col(f.name))  # NULL after a create reset
        out_cols.append(F.when(since_reset, F.col(f"_w_{f.name}.v")).otherwise(base).cast(f.dataType).alias(f.name))
    return joined.filter(keep).select(key, *out_cols)


def apply_changes(state: DataFrame, changes: DataFrame, key: str = "key", payload: str = "payload",
                  bucket_width: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """M8: apply an ordered stream of create / update / delete changes to keyed records at once.

    Per key, the last create or delete (the *reset*) decides the base: after a create the record is
    rebuilt from that create and the changes after it; after a delete the record is gone; with no
    reset the current record is the base. Each field is then the value from the latest change
    (at or after the reset) whose payload has that key. Equal to replaying the changes one by one
    in ``seq`` order, where a create on a live key is a reset and updates to absent keys are
    rejected. Returns ``(new state, rejects)``.

    A change with an operation other than create, update or delete, and a create or update whose
    payload ``change_fault`` finds fault with, is rejected with that reason and has no effect.

    ``seq`` is expected to be unique per key. If two changes of a key share one, the fold still
    picks deterministically (the greater operation or value wins the struct comparison), but the
    reject scan orders them arbitrarily.
    """
    fields = _field_schema(state, key)
    new_state = finalize_fold(state, fold_changes(changes, fields, key, payload), key)

    # rejects: faulty changes, and updates and deletes whose key is not live when they apply
    checked = _checked(changes.select(key, "seq", "op", payload), fields, payload).select(key, "seq", "op", payload, "_fault")
    marker = F.when(F.col("op").isin(*RESET_OPS) & F.col("_fault").isNull(), F.col("op"))
    seqd = carry_last(checked, key, "seq", marker, RESET_OPS, "_prev", bucket_width)
    live_now = seqd.join(state.select(key).withColumn("_present", F.lit(True)), key, "left")
    absent = (F.col("op") != "create") & (F.col("_prev").isNull() & F.col("_present").isNull() | (F.col("_prev") == "delete"))
    reason = F.coalesce("_fault", F.when(absent, F.lit("absent key")))
    rejects = live_now.select(key, "seq", "op", payload, reason.alias("reason")).where(F.col("reason").isNotNull())
    return new_state, rejects
