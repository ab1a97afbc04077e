"""Jobs over columns of query texts and of assistant replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a query may begin, and the words it may not contain.
ALLOWED_LEAD = r"(?i)^\s*(WITH|SELECT|EXPLAIN)\b"
FORBIDDEN = (
    r"(?i)\b(INSERT|UPDATE|DELETE|DROP|ALTER|CREATE|REPLACE|ATTACH|DETACH|PRAGMA|VACUUM)\b"
)
# The verdict texts, in the order the rules are tried.
EMPTY = "empty query"
BAD_LEAD = "only SELECT / WITH / EXPLAIN allowed"
BLOCKED = "DML and DDL keywords are blocked"
STACKED = "only one statement per run"
OK = "ok"

# The fenced block and the prefix a reply may carry.
FENCE = r"(?is)```(?:sql)?\s*(.*?)```"
PREFIX = r"(?i)^(sql|sqlite)\s*:\s*"


def sql_verdict(sql: Column) -> Column:
    """The first rule a query text breaks, or ``ok``."""
    body = F.regexp_replace(F.regexp_replace(sql, r"^\s+|\s+$", ""), r";+$", "")
    return (
        F.when(sql.isNull() | sql.rlike(r"^\s*$"), EMPTY)
        .when(~sql.rlike(ALLOWED_LEAD), BAD_LEAD)
        .when(sql.rlike(FORBIDDEN), BLOCKED)
        .when(body.contains(";"), STACKED)
        .otherwise(OK)
    )


def extract_sql(reply: Column) -> Column:
    """The statement in a reply: its first fenced block, else the whole text, ended by one ``;``."""
    body = F.when(reply.rlike(FENCE), F.regexp_extract(reply, FENCE, 1)).otherwise(reply)
    body = F.regexp_replace(body, r"^\s+|\s+$", "")
    body = F.regexp_replace(body, r";+$", "")
    body = F.regexp_replace(body, r"^\s+|\s+$", "")
    statement = F.concat(F.regexp_replace(body, PREFIX, ""), F.lit(";"))
    return F.when(reply.isNull() | (reply == ""), "").otherwise(statement)
