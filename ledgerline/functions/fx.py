"""Currency conversion to EUR.

Four forms, from cheapest to most general:

* ``convert_to_eur`` — a CASE expression over a fixed, tiny rate map (no join);
* ``convert_with_rates`` — equi-join to a (currency, rate) table;
* ``convert_with_dated_rates`` — rates valid from a date until the next change,
  joined as-of the fact date;
* ``convert_asof`` — the same for rate tables as large as facts (a rate a minute,
  thousands of currencies), by union and last known value in blocks of time.

Only the first two reproduce the reference; the dated form is the extension it
names.  Currency codes are matched exactly (no trim, no case folding), so
``' EUR'`` converts to NULL like the original.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# EUR per unit of currency; EUR passes through unrounded,
# every other listed currency is multiplied and rounded to 2 decimals;
# an unlisted currency converts to NULL.
FIXED_EUR_RATES = {"EUR": None, "SEK": Decimal("0.088")}

MONEY = "decimal(18,2)"
RATE = "decimal(18,6)"


def convert_to_eur(amount: Column | str, currency: Column | str,
                   rates: dict[str, Decimal | None] = FIXED_EUR_RATES) -> Column:
    """``amount`` in EUR as ``decimal(18,2)``; ``None`` rate = pass through."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    currency = F.col(currency) if isinstance(currency, str) else currency
    expr = None
    for code, rate in rates.items():
        value = amount if rate is None else F.round(amount * F.lit(rate), 2)
        cond = currency == F.lit(code)
        expr = F.when(cond, value.cast(MONEY)) if expr is None else expr.when(cond, value.cast(MONEY))
    return expr.otherwise(F.lit(None).cast(MONEY)) if expr is not None else F.lit(None).cast(MONEY)


def rates_frame(spark: SparkSession, rates: dict[str, Decimal | None] = FIXED_EUR_RATES) -> DataFrame:
    """The rate map as a (currency, rate_to_eur) table; pass-through = rate 1."""
    rows = [(k, Decimal(1) if v is None else v) for k, v in rates.items()]
    return spark.createDataFrame(rows, f"currency string, rate_to_eur {RATE}")


def convert_with_rates(df: DataFrame, amount: str, currency: str, rates: DataFrame,
                       out: str = "amount_eur") -> DataFrame:
    """Join ``rates`` (currency, rate_to_eur) on the currency code and add
    ``out`` = round(amount * rate, 2).  Catalyst broadcasts the rates when their
    size is under its threshold; otherwise it is a shuffle join."""
    r = rates.select(F.col("currency").alias("_fx_ccy"), F.col("rate_to_eur").alias("_fx_rate"))
    return (df.join(r, df[currency] == r["_fx_ccy"], "left")
            .withColumn(out, F.round(F.col(amount) * F.col("_fx_rate"), 2).cast(MONEY))
            .drop("_fx_ccy", "_fx_rate"))


def rate_periods(rates: DataFrame, currency: str = "currency", valid_from: str = "valid_from",
                 rate: str = "rate_to_eur") -> DataFrame:
    """(_fx_ccy, _fx_from, _fx_next, _fx_rate): the days [from, next) a rate
    holds; ``_fx_next`` is NULL for a currency's last rate, which stays open."""
    from pyspark.sql import Window

    nxt = F.lead(F.col(valid_from)).over(Window.partitionBy(currency).orderBy(valid_from))
    return rates.select(F.col(currency).alias("_fx_ccy"), F.col(valid_from).alias("_fx_from"), nxt.alias("_fx_next"),
                        F.col(rate).cast(RATE).alias("_fx_rate")).where(
        F.col("_fx_next").isNull() | (F.col("_fx_from") < F.col("_fx_next")))


def convert_with_dated_rates(df: DataFrame, amount: str, currency: str, on_date: str,
                             rates: DataFrame, out: str = "amount_eur") -> DataFrame:
    """As-of conversion: each fact uses the rate in force on ``on_date``.

    Closed rate periods are cut by month and met on (currency, month) with the day
    range inside; the open last rate of a currency is met on the currency
    alone, and only by facts on or after its start.  So no window ever sees
    the fact rows and no date is beyond the table.  Facts dated before the
    first rate get NULL.
    """
    periods = rate_periods(rates)
    closed = periods.where(F.col("_fx_next").isNotNull())
    months = closed.withColumn("_fx_month", F.explode(F.sequence(
        F.trunc("_fx_from", "MM"), F.trunc(F.date_sub("_fx_next", 1), "MM"), F.expr("INTERVAL 1 MONTH"))))
    last = periods.where(F.col("_fx_next").isNull()).select(
        F.col("_fx_ccy").alias("_fx_last_ccy"), F.col("_fx_from").alias("_fx_last_from"), F.col("_fx_rate").alias("_fx_last_rate"))
    day = F.col(on_date)
    met = (df[currency] == months["_fx_ccy"]) & (F.trunc(df[on_date], "MM") == months["_fx_month"]) \
        & (df[on_date] >= months["_fx_from"]) & (df[on_date] < months["_fx_next"])
    joined = df.join(months, met, "left")
    joined = joined.join(last, (joined[currency] == last["_fx_last_ccy"]) & (day >= last["_fx_last_from"]), "left")
    return (joined
            .withColumn(out, F.round(F.col(amount) * F.coalesce("_fx_rate", "_fx_last_rate"), 2).cast(MONEY))
            .drop("_fx_ccy", "_fx_from", "_fx_next", "_fx_rate", "_fx_month",
                  "_fx_last_ccy", "_fx_last_from", "_fx_last_rate"))


_NULL_KEY_SPREAD = 1024


def rates_as_of(moments: DataFrame, rates: DataFrame, block: str = "MONTH") -> DataFrame:
    """(_fx_ccy, _fx_at, _fx_rate): the rate in force at each distinct (_fx_ccy,
    _fx_at) of ``moments``; NULL before a currency's first rate.

    Rates and moments are laid on one line and cut into blocks of (currency,
    ``block`` of time).  A block starts with the last rate of the blocks
    before it, which a window over one row a block finds, so that no task ever sees a
    whole currency; inside, each moment takes the last rate before or at it.
    Of several rates with one start the largest holds; a NULL rate, currency or
    start is no rate.
    """
    from pyspark.sql import Window

    none = F.lit(None).cast(RATE)
    known = (rates.select(F.col("currency").alias("_fx_ccy"), F.col("valid_from").cast("timestamp").alias("_fx_at"),
                          F.col("rate_to_eur").cast(RATE).alias("_fx_rate"))
             .where(F.col("_fx_ccy").isNotNull() & F.col("_fx_at").isNotNull() & F.col("_fx_rate").isNotNull())
             .groupBy("_fx_ccy", "_fx_at").agg(F.max("_fx_rate").alias("_fx_rate")).withColumn("_fx_asked", F.lit(0)))
    asked = (moments.select("_fx_ccy", F.col("_fx_at").cast("timestamp").alias("_fx_at"))
             .where(F.col("_fx_ccy").isNotNull() & F.col("_fx_at").isNotNull()).distinct()
             .withColumn("_fx_rate", none).withColumn("_fx_asked", F.lit(1)))
    line = known.unionByName(asked).withColumn("_fx_block", F.date_trunc(block, "_fx_at"))
    closing = F.max_by("_fx_rate", F.when(F.col("_fx_asked") == 0, F.col("_fx_at")))
    before = Window.partitionBy("_fx_ccy").orderBy("_fx_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (line.groupBy("_fx_ccy", "_fx_block").agg(closing.alias("_fx_last"))
               .select("_fx_ccy", "_fx_block", F.last("_fx_last", ignorenulls=True).over(before).alias("_fx_rate"))
               .where(F.col("_fx_rate").isNotNull())
               .withColumn("_fx_at", F.lit(None).cast("timestamp")).withColumn("_fx_asked", F.lit(0)))
    inside = Window.partitionBy("_fx_ccy", "_fx_block").orderBy(F.col("_fx_at").asc_nulls_first(), "_fx_asked") \
        .rowsBetween(Window.unboundedPreceding, 0)
    return (line.unionByName(carried).withColumn("_fx_rate", F.last("_fx_rate", ignorenulls=True).over(inside))
            .where(F.col("_fx_asked") == 1).select("_fx_ccy", "_fx_at", "_fx_rate"))


def convert_asof(df: DataFrame, amount: str, currency: str, on_date: str, rates: DataFrame,
                 out: str = "amount_eur", block: str = "MONTH") -> DataFrame:
    """As-of conversion where neither side is small.

    The rate is looked up once per distinct (currency, moment) of the facts
    (``rates_as_of``; repeats are combined map-side), so a currency or a day that holds
    most facts is one row a task there.  The facts then meet the looked-up
    rates in an equi-join: AQE broadcasts them if they came out small, else splits a
    skewed (currency, moment).  Facts without currency or date get NULL and
    are spread by a salt.  Choose ``block`` so that one currency's rates and
    moments in it fit a task (MONTH for days, HOUR or MINUTE for ticks).
    """
    at = F.col(on_date).cast("timestamp")
    moments = df.select(F.col(currency).alias("_fx_ccy"), at.alias("_fx_at"))
    found = rates_as_of(moments, rates, block).withColumn("_fx_salt", F.lit(0))
    keyless = F.col(currency).isNull() | at.isNull()
    facts = df.withColumn("_fx_moment", at).withColumn("_fx_spread", F.when(
        keyless, F.lit(1) + F.pmod(F.xxhash64(amount), F.lit(_NULL_KEY_SPREAD))).otherwise(F.lit(0)).cast("int"))
    met = (facts[currency] == found["_fx_ccy"]) & (facts["_fx_moment"] == found["_fx_at"]) \
        & (facts["_fx_spread"] == found["_fx_salt"])
    return (facts.join(found, met, "left")
            .withColumn(out, F.round(F.col(amount) * F.col("_fx_rate"), 2).cast(MONEY))
            .drop("_fx_ccy", "_fx_at", "_fx_rate", "_fx_salt", "_fx_spread", "_fx_moment"))
