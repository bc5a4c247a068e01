"""The driver tables seen as retail tables, mission rows and mission documents.

All bindings are row-local projections over whole tables (customers also look up their nation).
Some columns are bent so that the checks have something to find:

* orders of unspecified priority have no customer;
* sales lines point at ``order + line - 1`` and ``part + line``, beyond the last key at the end;
* returned lines have a negative quantity and total, and unit prices are cut to the cent;
* raw tables hold two loads of customers, products and orders, and some malformed text;
* mission rows of one or two pieces and documents of one source have no identifier.

``oracles.py`` states the same in SQL.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _hundredths(number: Column) -> Column:
    """A double with two decimals as a whole number of hundredths."""
    return F.floor(number * 100 + 0.5)


def _exact(number: Column, kind: str = MONEY) -> Column:
    """A double with two decimals as an exact decimal.

    Built from the hundredths, as the direct cast goes through text for every row.
    """
    return (_hundredths(number).cast("decimal(12,0)") * F.lit(Decimal("0.01"))).cast(kind)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- typed retail tables -------------------------------------------------------------


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")
    )
    return table(spark, sf_dir, "customer").join(nations, "c_nationkey", "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lit("user"), "c_custkey", F.lit("@example.com")).alias("email"),
        "country",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        _exact(F.col("p_retailprice")).alias("list_price"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    price = _exact(F.col("l_extendedprice"), "decimal(12,2)")
    discount = _exact(F.col("l_discount"), "decimal(3,2)")
    returned = F.col("l_returnflag") == "R"
    quantity = F.col("l_quantity").cast("int")
    total = (price * (F.lit(1) - discount)).cast(MONEY)
    unit_price = F.floor(_hundredths(F.col("l_extendedprice")) / F.col("l_quantity")) / 100
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sale_id"),
        (F.col("l_orderkey") + F.col("l_linenumber") - 1).alias("order_id"),
        (F.col("l_partkey") + F.col("l_linenumber")).alias("product_id"),
        F.when(returned, -quantity).otherwise(quantity).alias("quantity"),
        _exact(unit_price).alias("unit_price"),
        discount.cast("decimal(5,2)").alias("discount_pct"),
        F.when(returned, -total).otherwise(total).alias("line_total"),
        F.col("l_linestatus").alias("line_status"),
        F.col("l_shipdate").cast("timestamp").alias("_ingest_ts"),
    )


def with_key_gaps(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The typed tables with each key lost where it happens to equal another column."""
    gaps = {
        "customers": ("customer_id", F.split_part("country", F.lit("_"), F.lit(2))),
        "products": ("product_id", F.floor("list_price")),
        "orders": ("order_id", F.col("customer_id")),
        "sales": ("sale_id", F.col("product_id")),
    }
    return {
        name: silver[name].withColumn(key, F.nullif(F.col(key), other.try_cast("bigint")))
        for name, (key, other) in gaps.items()
    }


def silver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": customers(spark, sf_dir),
        "products": products(spark, sf_dir),
        "orders": orders(spark, sf_dir),
        "sales": sales(spark, sf_dir),
    }


# --- raw retail tables ---------------------------------------------------------------


def _loaded(day: str) -> Column:
    return F.lit(day).cast("timestamp").alias("_ingest_ts")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    joined = base.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    signup = F.date_add(F.lit("1992-01-01").cast("date"), F.col("c_nationkey") * 30).cast("string")

    def load(mailbox: str, domain: str, day: str) -> DataFrame:
        return joined.select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.concat(F.lit(mailbox), "c_custkey", F.lit(domain)).alias("email"),
            F.when(F.col("c_acctbal") < 0, "unknown").otherwise(signup).alias("signup_date"),
            F.col("n_name").alias("country"),
            _loaded(day),
        )

    first = load("user", "@example.com", "2024-01-01")
    return first.unionByName(load("customer", "@example.org", "2024-01-02"))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "part")
    active = F.when(F.col("p_size") > 25, "True").when(F.col("p_size") > 10, "False").otherwise("unclear")

    def load(extra: int, day: str) -> DataFrame:
        price = _exact(F.col("p_retailprice")) + F.lit(extra)
        return base.select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            price.cast(MONEY).cast("string").alias("list_price"),
            active.alias("is_active"),
            _loaded(day),
        )

    return load(1, "2024-01-01").unionByName(load(0, "2024-01-02"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "orders")
    guest = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "guest")

    def load(status: Column, day: str) -> DataFrame:
        return base.select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.coalesce(guest, F.col("o_custkey").cast("string")).alias("customer_id"),
            F.col("o_orderdate").cast("date").cast("string").alias("order_date"),
            status.alias("order_status"),
            _loaded(day),
        )

    return load(F.lit("NEW"), "2024-01-01").unionByName(load(F.col("o_orderstatus"), "2024-01-02"))


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load of sales lines as text; a line without discount says so in words."""
    lines = sales(spark, sf_dir)
    text = {
        c: F.col(c).cast("string")
        for c in ("sale_id", "order_id", "product_id", "quantity", "unit_price", "line_total")
    }
    none = F.when(F.col("discount_pct") == 0, "none")
    text["discount_pct"] = F.coalesce(none, F.col("discount_pct").cast("string"))
    return lines.withColumns(text).drop("line_status")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": raw_customers(spark, sf_dir),
        "products": raw_products(spark, sf_dir),
        "orders": raw_orders(spark, sf_dir),
        "sales": raw_sales(spark, sf_dir),
    }


# --- missions ------------------------------------------------------------------------


def mission_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat mission row per sales line, with missing values of both kinds."""
    line = F.col("l_linenumber")
    status, flag = F.col("l_linestatus"), F.col("l_returnflag")
    day = F.date_format("l_shipdate", "MM/dd/yyyy")
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_quantity") == 1, "")
        .when(F.col("l_quantity") != 2, F.concat(F.lit("O-"), F.col("l_orderkey").cast("string")))
        .alias("mission_identifier"),
        day.alias("startDate"),
        F.when(status == "O", "").otherwise(day).alias("endDate"),
        F.when(line == 6, "")
        .when(line < 6, F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")))
        .alias("institution"),
        F.when(flag == "A", "PI").when(flag == "R", "CI").alias("role"),
        F.when(F.col("l_tax") > 0, F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("firstName"),
        F.when(status == "O", "").otherwise(F.concat(F.lit("L"), F.col("l_suppkey").cast("string"))).alias("lastName"),
    )


def mission_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per text: its lines are the people, their sentences the roles.

    The shape follows the language (lists, a plain role, no person object, people that
    are no list); two sources deliver raw prose and a wrapped document, both rejects.
    """
    lang, source = F.col("lang"), F.col("source")
    lines = F.split("text", "\n")
    named = F.struct(lang.alias("firstName"), source.alias("lastName"), F.lit("a@example.com").alias("emailAddress"))

    def people(role_of, person: Column) -> Column:
        return F.transform(lines, lambda line: F.struct(
            F.when(line != "", source).alias("institution"),
            role_of(line).alias("roles"),
            person.alias("person"),
        ))

    def sentences(line: Column) -> Column:
        return F.filter(F.split(line, r"\. "), lambda sentence: sentence != "")

    def document(entries: Column) -> Column:
        return F.to_json(F.struct(
            F.when(source != "src2", F.concat(F.lit("D-"), F.col("doc_id").cast("string"))).alias("identifier"),
            F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.col("n_chars").cast("int")), "MM/dd/yyyy")
            .alias("startDate"),
            entries.alias("people"),
        ))

    as_json = (
        F.when(lang == "de", document(people(lambda line: line, named)))
        .when(lang == "fr", document(people(lambda line: F.lit(None).cast("string"), lang)))
        .when(lang == "es", document(F.struct(lines.alias("lines"))))
        .otherwise(document(people(sentences, named)))
    )
    text = (
        F.when(source == "src0", F.col("text"))
        .when(source == "src1", F.concat(F.lit("["), as_json, F.lit("]")))
        .otherwise(as_json)
    )
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))


def link_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One index document per web page, listing its links."""
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return table(spark, sf_dir, "pages").select(
        "page_id", F.transform(links, lambda link: F.struct(link.alias("mission"))).alias("data")
    )
