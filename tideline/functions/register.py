"""The user functions as SQL functions: plain SQL bodies that Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tideline.functions import scalar as S


def register_functions(spark: SparkSession, hash_factor: int = S.HASH_FACTOR) -> None:
    """Register `hashCode(s)`, `user_scalar_func(n)` and `user_scalar_name(record)`.

    SQL functions cannot be overloaded, so the record form has its own name; `user_func` dispatches on
    the argument type in the DataFrame API. `precise_distinct` stays a pair of built-ins, see
    `operators.distinct`.
    """
    low, high = S.LOW_RANGE
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION hashCode(s STRING) RETURNS INT
        RETURN CASE WHEN s IS NOT NULL THEN CAST(
            pmod(CAST(java_method('java.util.Objects', 'hashCode', s) AS BIGINT) * {int(hash_factor)}L
                 + 2147483648L, 4294967296L) - 2147483648L AS INT) END""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION user_scalar_func(n BIGINT) RETURNS {S.USER_TYPE}
        RETURN CASE WHEN n IS NOT NULL THEN named_struct(
            'age', CAST(pmod(n, 4294967296L) - CASE WHEN pmod(n, 4294967296L) < 2147483648L THEN 0L ELSE 4294967296L END AS INT),
            'name', CASE WHEN n BETWEEN {low} AND {high} THEN '{S.LOW_NAME}' ELSE '{S.HIGH_NAME}' END,
            'totalBalance', CAST(CASE WHEN n BETWEEN {low} AND {high} THEN {S.LOW_BALANCE}
                                 ELSE {S.HIGH_BALANCE} END AS {S.BALANCE_TYPE})) END""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION user_scalar_name(u {S.USER_TYPE}) RETURNS STRING
        RETURN CASE WHEN u IS NOT NULL THEN
            CASE WHEN u.age BETWEEN {low} AND {high} THEN '{S.LOW_NAME}' ELSE '{S.HIGH_NAME}' END END""")
