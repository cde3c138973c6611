"""The sales hierarchy and the companies a user may see."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.filters import equal_to
from tradeloom.params import ALL, DashboardScope
from tradeloom.sources.model import Model

# Every active user starts a walk; only active children are followed.
WALK = """
    WITH RECURSIVE walk AS (
        SELECT node_id, node_name, node_code, division, node_type, parent_id
        FROM {node} WHERE node_type = 'USER' AND status = 1
        UNION ALL
        SELECT n.node_id, n.node_name, n.node_code, n.division, n.node_type, n.parent_id
        FROM {node} AS n JOIN walk AS w ON n.parent_id = w.node_id
        WHERE n.status = 1
    )
    SELECT DISTINCT * FROM walk
"""


def user_hierarchy(model: Model, type: str = ALL, id: str = ALL) -> DataFrame:
    """Active nodes below any active user, with the accounts assigned to each.

    ``type`` and ``id`` filter the nodes themselves, not their subtrees.
    """
    nodes = model.sales_node
    reached = nodes.sparkSession.sql(WALK, node=nodes)
    reached = equal_to(equal_to(reached, "node_type", type), "node_code", id)
    return reached.join(model.node_account, "node_id").select(
        F.col("node_id").alias("id"), F.col("node_name").alias("name"), F.col("node_code").alias("code"),
        "division", F.col("node_type").alias("type"), F.col("parent_id").alias("parent"),
        F.col("account_id").alias("acid"), F.col("node_id").alias("socode"),
        F.col("distributor_id").alias("companyid"),
    ).distinct()


def register_user_hierarchy(model: Model, name: str = "user_hierarchy") -> str:
    """Register ``user_hierarchy`` as an SQL table function of the session.

    ``SELECT * FROM user_hierarchy()``, ``user_hierarchy('USER')`` or
    ``user_hierarchy(id => 'U2')`` give the rows of the DataFrame call with
    the same arguments; both default to ``%`` (all).  As in the DataFrame
    call, an argument is trimmed of blanks (space, tab, line breaks) and
    upper-cased before it is compared; a null argument matches nothing.
    The model's two tables are registered as temporary views named after
    the function, so the function reads the same data as the model and
    Catalyst plans its body like any other query (the walk is the same
    recursive CTE).  Returns the function's name.
    """
    spark = model.sales_node.sparkSession
    node, account = f"{name}__node", f"{name}__account"
    model.sales_node.createOrReplaceTempView(node)
    model.node_account.createOrReplaceTempView(account)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in user_hierarchy(model).schema.fields)
    walk = WALK.format(node=node)

    def matches(column: str, argument: str) -> str:
        bare = f"regexp_replace({argument}, '^\\\\s+|\\\\s+$', '')"
        return f"({bare} = '{ALL}' OR {column} = upper({bare}))"

    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(type STRING DEFAULT '{ALL}', id STRING DEFAULT '{ALL}')
        RETURNS TABLE ({columns})
        RETURN SELECT DISTINCT r.node_id, r.node_name, r.node_code, r.division, r.node_type, r.parent_id,
                      a.account_id, r.node_id, a.distributor_id
        FROM ({walk}) AS r JOIN {account} AS a ON r.node_id = a.node_id
        WHERE {matches("r.node_type", "type")} AND {matches("r.node_code", "id")}
    """)
    return name


def distributors_in_scope(model: Model, scope: DashboardScope) -> DataFrame:
    """distributor_id and ``copies``: how often each of its vouchers counts.

    A restricted user sees a company once per account assigned to them.  The
    copies are carried as a weight instead of repeating every voucher line.
    """
    found = equal_to(equal_to(model.distributor, "distributor_id", scope.distributor), "region", scope.region)
    found = found.select("distributor_id")
    if not scope.restricted:
        return found.withColumn("copies", F.lit(1))
    seen = user_hierarchy(model, scope.type, scope.id).groupBy(F.col("companyid").alias("distributor_id")).agg(
        (F.lit(1) if scope.distinct_companies else F.count("*")).cast("int").alias("copies")
    )
    return found.join(seen, "distributor_id")
