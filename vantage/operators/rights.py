"""Rights through nested groups and containers (C1, R1): who holds which role on what.

An assignment gives a principal a role on a resource or on a container. It holds for every member of
that principal, through groups inside groups, and on everything the container contains, through
containers inside containers. Of several roles the strongest counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.operators.listing import DEFAULT_PERMISSION_ROLES
from vantage.session import scratch_path

# Roles from weakest to strongest.
ROLES = ("viewer", "editor", "admin")


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name, uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def closure(edges: DataFrame, outer: str, inner: str) -> DataFrame:
    """All (outer, inner) pairs connected by a chain of ``edges``; cycles are allowed (a node on one reaches itself).

    Chains double in length every round, so the rounds are the logarithm of the longest chain, and each
    round's pairs are written to the shared folder. The result has as many rows as there are connected
    pairs: meant for groups and containers, whose members and contents are joined afterwards.
    """
    pairs = _kept(edges.select(F.col(outer).alias("a"), F.col(inner).alias("b")).where("a IS NOT NULL AND b IS NOT NULL").distinct(),
                  "closure")
    known = pairs.count()
    while True:
        on = pairs.select(F.col("a").alias("b"), F.col("b").alias("c"))
        pairs = _kept(pairs.unionByName(pairs.join(on, "b").select("a", F.col("c").alias("b"))).distinct(), "closure")
        now = pairs.count()
        if now == known:
            return pairs.select(F.col("a").alias(outer), F.col("b").alias(inner))
        known = now


def reachable(edges: DataFrame, outer: str, inner: str) -> DataFrame:
    """(outer, inner) pairs connected by a chain of one or more ``edges``, where leaves (what is never ``outer``) may be
    many: only the nodes that hold others go through ``closure``; the leaves are joined once, at the end."""
    holders = edges.select(F.col(outer).alias(inner)).distinct()
    between = closure(edges.join(holders, inner, "left_semi"), outer, inner)
    direct = edges.select(outer, inner).where(F.col(outer).isNotNull() & F.col(inner).isNotNull())
    through = between.withColumnRenamed(inner, "_via").join(direct.withColumnRenamed(outer, "_via"), "_via").select(outer, inner)
    return direct.unionByName(between).unionByName(through).distinct()


def _strength(role: Column) -> Column:
    return F.array_position(F.array(*[F.lit(r) for r in ROLES]), role)


def held_directly(assignments: DataFrame, containment: DataFrame | None = None, resources: DataFrame | None = None) -> DataFrame:
    """(resource_id, principal_id, s): the strength of the strongest role assigned on a resource or a container around it.

    With ``resources``, what the containers hold is limited to them (and to containers) before it is expanded.
    """
    held = assignments.where("resource_id IS NOT NULL AND principal_id IS NOT NULL").select(
        "resource_id", "principal_id", _strength(F.col("role")).cast("int").alias("s")).where("s > 0")
    wanted = None if resources is None else resources.select("id").distinct()
    if containment is not None:
        if wanted is not None:
            holders = containment.select(F.col("container_id").alias("id"))
            containment = _kept(containment.join(wanted.unionByName(holders).distinct(), "id", "left_semi"), "containment")
        inside = reachable(containment, "container_id", "id").withColumnRenamed("container_id", "resource_id")
        held = held.unionByName(held.join(inside, "resource_id").select(F.col("id").alias("resource_id"), "principal_id", "s"))
    if wanted is not None:
        held = held.join(wanted.withColumnRenamed("id", "resource_id"), "resource_id", "left_semi")
    return held.groupBy("resource_id", "principal_id").agg(F.max("s").alias("s"))


def effective_roles(assignments: DataFrame, memberships: DataFrame | None = None, containment: DataFrame | None = None,
                    resources: DataFrame | None = None) -> DataFrame:
    """(resource_id, principal_id, role), the strongest role each principal holds on each resource.

    ``assignments``: resource_id (a resource or a container), principal_id, role. ``memberships``: group_id,
    member_id (a user or a group). ``containment``: container_id, id (a resource or a container).
    ``resources`` (id) limits the result; assignments on nothing of it are left out before groups are expanded.
    Rows with a NULL in a key give nothing; an unknown role is none.

    The roles are reduced to one per (resource, principal) before the members are joined, so a
    group's members meet each resource once.
    """
    held = held_directly(assignments, containment, resources)
    if memberships is not None:
        members = reachable(memberships, "group_id", "member_id").withColumnRenamed("group_id", "principal_id")
        passed = held.join(members, "principal_id").select("resource_id", F.col("member_id").alias("principal_id"), "s")
        held = held.unionByName(passed).groupBy("resource_id", "principal_id").agg(F.max("s").alias("s"))
    return held.select("resource_id", "principal_id", F.element_at(F.array(*[F.lit(r) for r in ROLES]), F.col("s")).alias("role"))


def permitted(resources: DataFrame, assignments: DataFrame, permission: str = "can_edit", memberships: DataFrame | None = None,
              containment: DataFrame | None = None, principals: DataFrame | None = None, block_rows: int = 1024,
              pairs_per_task: int = 2_000_000) -> DataFrame:
    """C1 in bulk: (principal_id, and the columns of ``resources``) for every resource a principal has ``permission`` on,
    directly or through groups and containers; ``principals`` (principal_id) limits the principals.

    The result can have as many rows as resources times principals, so none of them is shuffled. Resources that the
    same groups have the permission on are one class, and so are members of the same groups. Classes are compared;
    then the members of each, in blocks, are joined with the resources, and every pair comes up once. What is
    assigned to a principal itself is added unless a group of it has the permission.
    """
    if permission not in DEFAULT_PERMISSION_ROLES:
        raise ValueError(f"unknown permission {permission!r}")
    spark = resources.sparkSession
    enough = [ROLES.index(r) + 1 for r in DEFAULT_PERMISSION_ROLES[permission]]
    held = _kept(held_directly(assignments, containment, resources).where(F.col("s").isin(enough)).select("resource_id", "principal_id"), "held")
    limit = None if principals is None else principals.select("principal_id").distinct()

    def limited(pairs: DataFrame) -> DataFrame:
        return pairs if limit is None else pairs.join(limit, "principal_id", "left_semi")

    found = limited(held)
    if memberships is None:
        return found.withColumnRenamed("resource_id", "id").join(resources, "id").select("principal_id", *resources.columns)
    members = reachable(memberships, "group_id", "member_id").select(F.col("group_id").alias("via"), F.col("member_id").alias("principal_id"))
    members = limited(members.join(held.select(F.col("principal_id").alias("via")).distinct(), "via", "left_semi"))
    via = held.join(members.select(F.col("via").alias("principal_id")).distinct(), "principal_id", "left_semi")

    def classes(rows: DataFrame, key: str, group: str, name: str) -> DataFrame:
        # a row per key: the sorted groups name its class
        return _kept(rows.groupBy(key).agg(F.sort_array(F.collect_set(group)).alias(name)), "rights-classes")

    targets = classes(via, "resource_id", "principal_id", "target")
    owners = classes(_kept(members, "rights-members"), "principal_id", "via", "owner")
    met = _kept(targets.groupBy("target").agg(F.count("*").alias("n")).withColumn("group", F.explode("target"))
                .join(owners.select("owner").distinct().withColumn("group", F.explode("owner")), "group")
                .select("target", "owner", "n").distinct(), "rights-met")
    sizes = met.groupBy("owner").agg(F.sum("n").alias("met")).join(owners.groupBy("owner").agg(F.count("*").alias("n")), "owner")
    sizes = _kept(sizes.select("owner", (F.col("met") * F.col("n")).alias("pairs"), F.ceil(F.col("met") / (4 * block_rows)).cast("int").alias("rows"),
                               F.ceil(F.col("n") / block_rows).cast("int").alias("blocks")), "rights-sizes")
    key = ["owner", "row", "block"]
    packed = (owners.join(sizes, "owner").withColumn("block", F.pmod(F.xxhash64("principal_id"), F.col("blocks")).cast("int"))
              .groupBy("owner", "rows", "block").agg(F.collect_list("principal_id").alias("ids"))
              .select("owner", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"), "block", "ids"))
    of = resources.select(F.col("id").alias("resource_id"), F.struct(*resources.columns).alias("_of"))
    wanted = (targets.join(met.drop("n"), "target").join(sizes, "owner").join(of, "resource_id")
              .select("owner", F.pmod(F.xxhash64("resource_id"), F.col("rows")).cast("int").alias("row"),
                      F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "_of"))
    # a joined row is a block of pairs: tasks are dealt by the pairs, not by the small tables that are joined
    tasks = -(-(sizes.agg(F.sum("pairs")).first()[0] or 0) // pairs_per_task)
    if tasks > 1:
        wanted = wanted.repartition(max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))), *key)
    through = wanted.join(packed, key).select(F.explode("ids").alias("principal_id"), "_of.*")
    # assigned to the principal itself, and not through a group as well
    owned = found.join(owners, "principal_id", "left").join(targets, "resource_id", "left")
    alone = owned.where(F.coalesce(~F.arrays_overlap("owner", "target"), F.lit(True))).select("principal_id", F.col("resource_id").alias("id"))
    return through.unionByName(alone.join(resources, "id").select("principal_id", *resources.columns))
