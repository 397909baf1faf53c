"""API responses: a text column to its status and items, as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGE_LIMIT = "07"


def status(body: Column) -> Column:
    """struct(kind, code, message); kind: ok, gateway, backend, api or not_json."""
    at = lambda path: F.get_json_object(body, path)
    gateway, backend = "$.OpenAPI_ServiceResponse.cmmMsgHeader", "$['nkoneps.com.response.ResponseError'].header"
    code = F.trim(F.coalesce(at("$.response.header.resultCode"), F.lit("")))
    made = lambda kind, c, m: F.struct(F.lit(kind).alias("kind"), c.cast("string").alias("code"), m.cast("string").alias("message"))
    return (
        F.when(body.isNull() | F.try_parse_json(body).isNull(), made("not_json", F.lit(None), F.substring(body, 1, 200)))
        .when(at(gateway).isNotNull(), made("gateway", at(f"{gateway}.returnReasonCode"), F.concat_ws(" ", at(f"{gateway}.errMsg"), at(f"{gateway}.returnAuthMsg"))))
        .when(at(backend).isNotNull(), made("backend", at(f"{backend}.resultCode"), at(f"{backend}.resultMsg")))
        .when(code != "00", made("api", code, at("$.response.header.resultMsg")))
        .otherwise(made("ok", code, F.lit(None)))
    )


def failure_class(status_column: str, first_call: Column) -> Column:
    """daily_quota, rate, range or other, by typed codes; null when ok. HTTP 429 on a run's first call is the daily quota."""
    kind, code = F.col(f"{status_column}.kind"), F.col(f"{status_column}.code")
    quota = F.col(f"{status_column}.message").contains("LIMITED_NUMBER_OF_SERVICE_REQUESTS")
    return F.when(kind == "ok", F.lit(None).cast("string")).when(quota | ((code == "429") & first_call), "daily_quota").when(code == "429", "rate").when(code == RANGE_LIMIT, "range").otherwise("other")


def items(body: Column, record: str) -> Column:
    """The records (DDL ``record``) of any of the shapes [..], {item: [..]} and {item: {..}}; empty if none."""
    raw = F.get_json_object(body, "$.response.body.items")
    inner = F.get_json_object(raw, "$.item")
    as_list = lambda c: F.when(c.startswith("["), F.from_json(c, f"array<{record}>"))
    as_one = F.when(inner.startswith("{"), F.array(F.from_json(inner, record)))
    return F.coalesce(as_list(F.ltrim(raw)), as_list(F.ltrim(inner)), as_one, F.array().cast(f"array<{record}>"))


def total_count(body: Column) -> Column:
    return F.coalesce(F.get_json_object(body, "$.response.body.totalCount").try_cast("long"), F.lit(0))


def parse_pages(df: DataFrame, body: str, record: str) -> DataFrame:
    """df with status, total_count and items in place of the response text."""
    c = F.col(body)
    return df.withColumns({"status": status(c), "total_count": total_count(c), "items": items(c, record)}).drop(body)
