"""The scalar and table functions under their usual names, for SQL users.

Beside a table's rows they become joins: those that look up a key or list a row's properties equality joins; the
lookups by containment or prefix compare the distinct texts with their whole list, so large tables take the operators
instead, which need no such comparison.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from fleetmart.plans.views import COMPUTER_PROPERTIES, SERVER_PROPERTIES

DOTTED = "replace(rtrim(left({x}, 255)), ';', '.')"
BEFORE_LAST = (
    "if(contains({x}, '.'), left({x}, length({x}) - length(substring_index({x}, '.', -1)) - 1), {x})"
)


def _before_last_dot(text: str) -> str:
    return BEFORE_LAST.replace("{x}", f"({text})")


def _text_functions() -> dict[str, str]:
    after_colon = "substr({x}, instr({x}, ':') + 1, 255)"
    after_dot = "substr({x}, instr({x}, '.') + 1, 255)"
    dotted = DOTTED.replace("{x}", "fullname")
    tail = after_dot.replace("{x}", f"({after_colon.replace('{x}', f'({dotted})')})")
    replaced = """if(contains(rtrim(input), find),
        concat(left(rtrim(input), length(rtrim(input)) - length(substring_index(rtrim(input), find, -1)) - 1),
               repl, substring_index(rtrim(input), find, -1)), input)"""
    return {
        "ReplaceLastOccurrence(input STRING, find STRING, repl STRING) RETURNS STRING": replaced,
        "BuildPath(path STRING) RETURNS STRING": (
            "left(ReplaceLastOccurrence(left(path, 256), '.', ';'), 250)"
        ),
        "CutDomain(fullname STRING) RETURNS STRING": (
            f"if(contains(fullname, ':'), {_before_last_dot(tail)}, NULL)"
        ),
        "CutMaschine(name STRING) RETURNS STRING": _before_last_dot(DOTTED.replace("{x}", "name")),
    }


def _one(value: str, table: str, where: str) -> str:
    return f"(SELECT {value} FROM {table} WHERE {where})"


def _lookup_functions() -> dict[str, str]:
    domain = """domain <> '' AND contains(lower(rtrim(DomainDnsName)), lower(rtrim(left(domain, 100))))"""
    best = "struct(-length(DomainDnsName), DomainId)"
    prefix = "startswith(lower(rtrim(ver)), lower(rtrim(productversion)))"
    release = "min_by(sqlversion, struct(-length(productversion), sqlversion))"
    key = "CustomerId = customer"
    type_id = "ManagedEntityTypeRowId = type_id"
    functions = {
        "GetCustomerName(domain STRING)": _one(
            f"min_by(coalesce(CustomerName, '???'), {best})", "CustomerDomain", domain
        ),
        "GetCustomerNameShort(domain STRING)": _one(
            f"min_by(coalesce(CustomerShortName, '???'), {best})", "CustomerDomain", domain
        ),
        "GetCustomerNameLong(customer INT)": _one("min(NameLong)", "Customer", key),
        "GetCustomerNameLong4Domain(customer INT)": _one("min(NameLong)", "Customer", key),
        "GetCustomerNameShort4Domain(customer INT)": _one("min(Name)", "Customer", key),
        "GetDatabaseType(type_id INT)": _one(
            "min(ManagedEntityTypeSystemName)", "ManagedEntityDatabaseType", type_id
        ),
        "GetSQLVersion(ver STRING)": _one(release, "SQLVersion", prefix),
    }
    dated = "SQLVersion LEFT JOIN Support ON VersionNr = try_cast(left(sqlversion, 10) AS INT)"
    first = "struct(-length(productversion), sqlversion, -unix_date(ReleaseDate))"
    for function, column in {
        "GetEndOfMainstream": "EndOfMainstream",
        "GetEndofExtended": "EndofExtended",
    }.items():
        body = _one(f"cast(min_by({column}, {first}) AS STRING)", dated, prefix)
        functions[f"{function}(ver STRING)"] = body
    texts = {f"{signature} RETURNS STRING": body for signature, body in functions.items()}
    count = _one("cast(count(*) AS INT)", "CustomerDomain", key)
    return {**texts, "fn_CustDomainCount(customer INT) RETURNS INT": count}


def _list_function(name: str, argument: str, table: str, where: str, columns: list[str]) -> str:
    # The condition stays outside the unfolding, so that the function can stand beside a table's rows as a join.
    cells = ", ".join(f"struct('{c}', cast({c} AS STRING))" for c in columns)
    return f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}({argument})
        RETURNS TABLE(Property STRING, Wert STRING)
        RETURN SELECT Property, Wert FROM {table} LATERAL VIEW inline(array({cells})) cells AS Property, Wert
               WHERE {where} AND rtrim(Wert) <> ''"""


def register_functions(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Create the fourteen scalar and two table functions for this session.

    ``tables`` holds Customer, CustomerDomain (with its customers' names), SQLVersion, Support,
    ManagedEntityDatabaseType, and SQLServer and Computer with their derived columns.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    for signature, body in {**_text_functions(), **_lookup_functions()}.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    lists = [
        _list_function(
            "SQLPropList", "entity BIGINT", "SQLServer", "ManagedEntityRowId = entity", SERVER_PROPERTIES
        ),
        _list_function(
            "ComputerPropList",
            "machine STRING",
            "Computer",
            "lower(rtrim(Maschine)) = lower(rtrim(machine))",
            COMPUTER_PROPERTIES,
        ),
    ]
    for text in lists:
        spark.sql(text)
