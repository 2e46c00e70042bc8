"""Plugins: functions from documents to documents, as columns where Spark has the function, else as pandas UDFs."""

from __future__ import annotations

import importlib
import os
import pkgutil
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

Plugin = Callable[[DataFrame], DataFrame]
REGISTRY: dict[str, Plugin] = {}


def plugin(name: str) -> Callable[[Plugin], Plugin]:
    def add(f: Plugin) -> Plugin:
        REGISTRY[name] = f
        return f

    return add


def discover(package: str) -> list[str]:
    """Imports all modules of a package, which register their plugins; gives the names that came."""
    before = set(REGISTRY)
    found = importlib.import_module(package)
    for m in pkgutil.walk_packages(getattr(found, "__path__", []), f"{package}."):
        importlib.import_module(m.name)
    return sorted(set(REGISTRY) - before)


CREDENTIALS: list[Callable[[str], str | None]] = [os.environ.get]


def credentials(key: str) -> str | None:
    """The first answer of the registered providers, the last registered first; the environment comes last."""
    return next((v for v in (ask(key) for ask in reversed(CREDENTIALS)) if v is not None), None)


def run(documents: DataFrame, names: list[str] | tuple[str, ...]) -> DataFrame:
    """The named plugins in the order given; documents whose _source becomes null are left out."""
    for name in names:
        if name not in REGISTRY:
            raise KeyError(f"unknown plugin {name}")
        documents = REGISTRY[name](documents)
    return documents.where("_source is not null")


def with_field(documents: DataFrame, name: str, value: Column) -> DataFrame:
    return documents.withColumn("_source", F.when(F.col("_source").isNotNull(), F.col("_source").withField(name, value)))


def constant(name: str, value: str) -> Plugin:
    return lambda documents: with_field(documents, name, F.lit(value))


for _n, _v in (("Hero", "hero"), ("Villain", "villain"), ("Groot", "groot")):
    REGISTRY[_n] = constant(_v, _n)


def mask_email(c: Column) -> Column:
    return F.when(c.contains("@"), F.concat(F.left(c, F.lit(1)), F.lit("***@"), F.substring_index(c, "@", -1))).otherwise(F.lit("***"))


def mask_last4(c: Column) -> Column:
    digits = F.regexp_replace(c, r"\D", "")
    return F.when(F.length(digits) >= 4, F.concat(F.lit("***"), F.right(digits, F.lit(4)))).otherwise(F.lit("***"))


def mask_id(c: Column) -> Column:
    return F.left(F.sha2(c.cast("string"), 256), F.lit(16))


MASKS: dict[str, Callable[[Column], Column]] = {
    **{n: (lambda c: F.when(c.isNotNull(), F.lit("[REDACTED]"))) for n in ("ssn", "password", "secret")},
    "email": mask_email, "phone": mask_last4, "card": mask_last4, "user_id": mask_id, "customer_id": mask_id,
}


@plugin("Masking")
def masking(documents: DataFrame) -> DataFrame:
    """Fields of the names in MASKS are masked."""
    for f in documents.schema["_source"].dataType.fieldNames():
        if f in MASKS:
            documents = with_field(documents, f, MASKS[f](F.col("_source")[f]))
    return documents


def slug_text(text: str | None) -> str | None:
    """ASCII letters and digits in lower case, joined by hyphens, cut to 100 at the last of them."""
    if text is None:
        return None
    plain = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()
    plain = re.sub(r"-{2,}", "-", re.sub(r"[^a-z0-9-]", "", re.sub(r"[\s_]+", "-", plain))).strip("-")
    return plain if len(plain) <= 100 else plain[:100].rsplit("-", 1)[0]


@F.pandas_udf(StringType())
def slug(text: pd.Series) -> pd.Series:
    return text.map(slug_text)


@plugin("Slug")
def add_slug(documents: DataFrame) -> DataFrame:
    return with_field(documents, "slug", slug(F.col("_source.title")))


@plugin("MultiFieldSlug")
def add_slugs(documents: DataFrame) -> DataFrame:
    return with_field(documents, "slug", F.concat_ws("-", slug(F.col("_source.title")), slug(F.col("_source.id").cast("string"))))


@plugin("Geometry")
def geometry(documents: DataFrame) -> DataFrame:
    """`geometry` {type, coordinates}: points become their coordinates, other shapes stay in `shape`."""
    g = F.col("_source.geometry")
    documents = with_field(documents, "coordinates", F.when(g["type"] == "Point", g["coordinates"]))
    return with_field(documents, "shape", F.when(F.col("_source.geometry.type") != "Point", F.col("_source.geometry")))


def finite_date(c: Column) -> Column:
    return (
        F.when(c == "infinity", F.lit("9999-12-31 23:59:59.999999").cast("timestamp_ntz"))
        .when(c == "-infinity", F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))
        .otherwise(F.try_to_timestamp(c).cast("timestamp_ntz"))
    )


@plugin("Infinity")
def infinity(documents: DataFrame) -> DataFrame:
    return with_field(documents, "publish_date", finite_date(F.col("_source.publish_date")))


def embedding(embed: Callable[[list[str]], list[list[float]]]) -> Plugin:
    """A plugin that adds `embedding` of title or else description, by a provider's function on batches of texts."""

    @F.pandas_udf("array<float>")
    def vectors(text: pd.Series) -> pd.Series:
        return pd.Series(embed(text.fillna("").tolist()))

    def run_(documents: DataFrame) -> DataFrame:
        return with_field(documents, "embedding", vectors(F.coalesce(F.col("_source.title"), F.col("_source.description"))))

    return run_
