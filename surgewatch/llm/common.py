"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from surgewatch.session import checkpoint_dir

#: ASCII white space, as the word patterns of the operators define it (fixed value).
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there: what follows
    neither recomputes it nor depends on an executor's local files."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column used inside a lambda would be evaluated anew for every element;
    as the lambda variable of a one-element array it is evaluated once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def named(df: DataFrame, *skip: str) -> list[Column]:
    """The columns of ``df`` but ``skip``, whatever their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c not in skip]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each made longer until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def ascii_lower(c: Column) -> Column:
    """A-Z only; ``lower`` would also change other letters."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text (null: none)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")) \
        .otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def broadcast_if_small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Broadcast hint only where the counted ``rows`` are within ``limit``."""
    return F.broadcast(df) if rows <= limit else df


__all__ = ["SPACES", "table", "cut", "let", "named", "fresh", "ascii_lower", "words", "broadcast_if_small"]
