"""Quantities recorded in different units: rents and deposits to US dollars.

A price text is read into numbers and unit tokens (currency, size of unit, period). Tokens restrict the unit
combinations a number may have; where they leave several, the combination with the smallest log residual of the
identities between the columns is taken, and a tie between combinations of different amounts is flagged:

* a recorded column holds the amount in some unit of record (dollars, cents, the bare number of the text),
* a deposit is a number of monthly rents (between ``RATIO``), and a text keeps to one unit: where a unit of either is open, the
  combinations of both are weighed together.

A text without a word for the period means months. Amounts whose combination is not unique are no result of ``misrecorded``;
``undecided`` lists them.

All of it is column expressions, one pass without a shuffle. ``unit_rates`` is a fixed table; it is read to the
driver only up to ``MAX_RATES`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RATES = 1000
#: Fewest and most monthly rents that a deposit is.
RATIO = (0.5, 60.0)
#: Log residual of two units in one text.
UNLIKE = 0.1
#: Log residuals closer than this count as equal.
TIE = 1e-6

NUM = r"\d[\d,]*(?:\.\d+)?"
DEPOSIT = r"(?is)(?:보증금|전세금|전세|deposit|보(?=\s*[\d₩$]))\s*:?\s*(.*?)(?=\s*(?:\n|\)|/|, |\+ | \(|$| 월세 *[\d₩$]))"
PAIR = rf"^\s*({NUM})\s*/\s*({NUM})\s*(?=만)"
MONTHS = rf"(?i)({NUM})\s*(?:달|개월|months?)"


def rates(unit_rates: DataFrame) -> dict[str, dict[str, str]]:
    """kind -> unit -> factor, as exact decimal text."""
    rows = unit_rates.where("unit_name is not null and kind is not null and factor is not null").limit(MAX_RATES + 1).collect()
    if len(rows) > MAX_RATES:
        raise ValueError(f"unit_rates has more than {MAX_RATES} rows")
    out: dict[str, dict[str, str]] = {}
    for r in rows:
        out.setdefault(r.kind, {})[r.unit_name] = format(r.factor, "f") if r.factor == int(r.factor) else repr(r.factor)
    return out


def _dec(text: Column) -> Column:
    return F.regexp_replace(text, ",", "").try_cast("decimal(20,6)")


def _of(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _clauses(df: DataFrame, price: str) -> DataFrame:
    """Adds _d (what the deposit clause says), _r (the rest), _man (the unit 만 holds for all numbers), _none (no deposit)."""
    text = F.trim(F.col(price))
    df = df.withColumns({"_t": text, "_pair": text.rlike(PAIR), "_none": text.rlike(r"(?i)no\s+deposit|보증금\s*(?:없음|없는)|무보증")})
    t = F.col("_t")
    return df.withColumns(
        {
            "_d": F.when(F.col("_pair"), F.regexp_extract(t, PAIR, 1)).otherwise(F.regexp_extract(t, DEPOSIT, 1)),
            "_r": F.when(F.col("_pair"), F.regexp_extract(t, PAIR, 2)).otherwise(F.regexp_replace(F.regexp_replace(t, DEPOSIT, " "), r"\(\s*단위[^)]*\)?", " ")),
            "_man": F.col("_pair") | t.rlike(r"단위\s*:\s*만"),
        }
    )


def _numbers(df: DataFrame, clause: str, to: str) -> DataFrame:
    """Adds {to}_n (number), {to}_s (size of unit), {to}_c (currency) of a clause; the last two NULL where no token gives them."""
    c = F.col(clause)
    df = df.withColumns(
        {
            "_eok": _dec(_of(c, rf"({NUM})\s*억")),
            "_m": _dec(_of(c, rf"({NUM})\s*(?:천|백)?\s*만")) * F.when(c.rlike(r"\d\s*천\s*만"), 1000).when(c.rlike(r"\d\s*백\s*만"), 100).otherwise(1).cast("decimal(4,0)"),
            "_plain": _dec(_of(c, rf"({NUM})")),
            "_k": c.rlike(rf"{NUM}\s*(?:[kK]\b|천)"),
            "_won": c.rlike(r"₩|원|(?i:KRW)"),
            "_usd": c.rlike(r"\$|불|달러|(?i:USD)|\d\s*[kK]\b"),
        }
    )
    big, man = F.col("_eok").isNotNull(), F.col("_eok").isNotNull() | F.col("_m").isNotNull() | F.col("_man")
    currency = F.when(man | F.col("_won"), "KRW").when(F.col("_usd"), "USD")
    number = F.when(big, (F.col("_eok") * F.lit(10000).cast("decimal(5,0)")).cast("decimal(24,6)") + F.coalesce("_m", F.lit(0))).otherwise(F.coalesce("_m", "_plain"))
    df = df.withColumns({f"{to}_n": number.cast("decimal(26,6)"), f"{to}_c": currency, f"{to}_s": F.when(man, 10000).when(F.col("_k"), 1000).when(currency.isNotNull(), 1).cast("decimal(10,0)")})
    return df.drop("_eok", "_m", "_plain", "_k", "_won", "_usd")


def resolve(listings: DataFrame, unit_rates: DataFrame, price: str = "price_raw_ko", rent: str = "rent_monthly_usd", deposit: str = "deposit_usd") -> DataFrame:
    """Adds ``rent_cents``, ``deposit_cents`` (long, NULL where the text gives none), ``rent_unique`` and ``deposit_unique``.

    NULL, empty and amountless texts give NULL cents and unique flags of NULL. Zero or negative columns take no part in the
    residuals. Repeated rows stay. Columns of these four names already present are replaced; other columns are kept.
    """
    known = rates(unit_rates)
    money = {k: F.lit(v).cast("decimal(20,10)") for k, v in known.get("usd_per_unit", {}).items()}
    per_year = {k: F.lit(v).cast("decimal(12,4)") for k, v in known.get("units_per_year", {}).items()}
    kept = [c for c in listings.columns if c not in ("rent_cents", "deposit_cents", "rent_unique", "deposit_unique")]
    work = _clauses(listings.select(*[F.col(f"`{c}`") for c in kept]), price)
    work = _numbers(_numbers(work, "_d", "_dep").withColumn("_r2", F.regexp_replace("_r", r"(\d+)\s*(?:박|년|주일|주|일)\s+(?=\D{0,3}\d)", " ")), "_r2", "_rent")
    r = F.col("_r")
    unit = (
        F.when(r.rlike(r"(?i)/\s*w(?:ee)?k|per\s*week|weekly|주당|주일|/\s*주|매주"), "week")
        .when(r.rlike(r"(?i)/\s*(?:day|night)|per\s*(?:day|night)|daily|nightly|하루|\d\s*박|일당|/\s*일"), "day")
        .when(r.rlike(r"(?i)/\s*y(?:ea)?r|per\s*year|yearly|annual|\d\s*년|연\s*[$₩\d]|연간|/\s*년"), "year")
        .otherwise("month")
    )
    months = _dec(_of(F.col("_d"), MONTHS))
    work = work.withColumns(
        {
            "_unit": unit,
            "_count": F.coalesce(_of(r, r"^\D*?(\d+)\s*(?:박|년|주일|주|일)\s+(?=\D{0,3}\d)").try_cast("decimal(6,0)"), F.lit(1).cast("decimal(6,0)")),
            "_months": F.when(~F.col("_none"), months).cast("decimal(10,2)"),
        }
    ).withColumn("_dep_n", F.when(~F.col("_none") & F.col("_months").isNull(), F.col("_dep_n")))
    periods = F.lit(None).cast("decimal(12,4)")
    for name, f in per_year.items():
        periods = F.when(F.col("_unit") == name, f).otherwise(periods)
    combos = [(c, s, f) for c, f in sorted(money.items()) for s in (1, 1000, 10000)]

    def log_gap(a: Column, b: Column) -> Column:
        return F.when((a > 0) & (b > 0), F.abs(F.ln(a.cast("double")) - F.ln(b.cast("double"))))

    def scored(q: str, column: str, least: float) -> Column:
        """The combinations that the tokens allow, as sorted structs of residual and dollars."""

        def one(c: str, s: int, rate: Column) -> Column:
            own = (F.col(f"{q}_n") * F.lit(s).cast("decimal(10,0)")).cast("decimal(28,6)")
            usd = (own * rate).cast("decimal(38,12)")
            seen = F.col(f"`{column}`")
            record = F.least(log_gap(seen, usd), log_gap(seen, usd * 100), log_gap(seen, own))
            level = F.greatest(F.lit(0.0), F.ln(F.lit(least)) - F.ln(F.greatest(usd.cast("double"), F.lit(1e-9))))
            fits = F.coalesce(F.col(f"{q}_c") == c, F.lit(True)) & F.coalesce(F.col(f"{q}_s") == s, F.lit(True))
            return F.when(fits, F.struct((F.coalesce(record, F.lit(0.0)) + level).alias("residual"), usd.alias("usd"), F.lit(f"{c}{s}").alias("unit")))

        return F.when(F.col(f"{q}_n").isNotNull(), F.array_sort(F.array_compact(F.array(*[one(*x) for x in combos]))))

    work = work.withColumns({"_rents": scored("_rent", rent, 100.0), "_deps": scored("_dep", deposit, 50.0), "_periods": periods})
    months_of = (F.col("_periods") / 12).cast("double") / F.col("_count").cast("double")

    def ratio(r: Column, d: Column) -> Column:
        """How far the deposit is from a plausible number of monthly rents, in logarithms."""
        rent_, dep = r["usd"].cast("double") * months_of, d["usd"].cast("double")
        off_ = F.greatest(F.lit(0.0), F.ln(rent_ * RATIO[0]) - F.ln(dep), F.ln(dep) - F.ln(rent_ * RATIO[1]))
        return r["residual"] + d["residual"] + F.when((rent_ > 0) & (dep > 0), off_).otherwise(0.0) + F.when(r["unit"] == d["unit"], 0.0).otherwise(UNLIKE)

    both = (F.size("_rents") > 0) & (F.size("_deps") > 0) & (F.size("_rents") + F.size("_deps") > 2)
    joint = F.flatten(F.transform("_rents", lambda r: F.transform("_deps", lambda d: F.struct(ratio(r, d).alias("residual"), r["usd"].alias("_rents"), d["usd"].alias("_deps")))))
    work = work.withColumn("_joint", F.when(both, F.array_sort(joint)))
    first = F.get("_joint", F.lit(0))
    best = lambda c: F.when(both, first[c]).otherwise(F.get(F.col(c), F.lit(0))["usd"])
    # a rival is a combination of another amount that fits as well
    rivals = lambda c: F.exists("_joint", lambda x: (x[c] != first[c]) & (x["residual"] - first["residual"] <= TIE))
    unique = lambda c: F.when(both, ~rivals(c)).when(F.size(c) > 0, (F.size(c) == 1) | (F.get(F.col(c), F.lit(1))["residual"] - F.get(F.col(c), F.lit(0))["residual"] > TIE))
    hundred = F.lit(100).cast("decimal(3,0)")
    work = work.withColumns({"_yearly": (best("_rents").cast("decimal(24,8)") * F.col("_periods") * hundred).cast("decimal(32,8)"), "_twelfths": (F.lit(12).cast("decimal(2,0)") * F.col("_count")).cast("decimal(8,0)")})

    def half_up(numerator: Column, divisor: Column) -> Column:
        # floor of (2n + d) / 2d is half up on the exact quotient
        two = F.lit(2).cast("decimal(1,0)")
        return F.floor(((numerator * two + divisor).cast("decimal(36,8)") / (divisor * two).cast("decimal(9,0)")).cast("decimal(38,12)")).cast("long")

    deposit_cents = F.coalesce(
        half_up((F.col("_yearly").cast("decimal(26,8)") * F.col("_months")).cast("decimal(34,8)"), F.col("_twelfths")),
        half_up((best("_deps").cast("decimal(28,8)") * hundred).cast("decimal(34,8)"), F.lit(1).cast("decimal(8,0)")),
    )
    return work.withColumns(
        {
            "rent_cents": half_up(F.col("_yearly"), F.col("_twelfths")),
            "deposit_cents": F.when(F.col("_none"), F.lit(0).cast("long")).otherwise(deposit_cents),
            "rent_unique": unique("_rents"),
            "deposit_unique": F.when(F.col("_none") | F.col("_months").isNotNull(), F.lit(True)).otherwise(unique("_deps")),
        }
    ).select(*[F.col(f"`{c}`") for c in kept], "rent_cents", "deposit_cents", "rent_unique", "deposit_unique")


def misrecorded(listings: DataFrame, unit_rates: DataFrame) -> DataFrame:
    """One row (listing_id, quantity, usd_cents) per amount that the text gives uniquely and the column lacks or contradicts."""
    done = resolve(_priced(listings), unit_rates)

    def off(column: str, cents: str) -> Column:
        recorded = F.floor(F.col(column) * 100).cast("long")
        sure = F.coalesce(F.col(cents.replace("cents", "unique")), F.lit(True))
        return sure & F.col(cents).isNotNull() & (F.col(column).isNull() | (recorded != F.col(cents)))

    rows = F.array(
        F.struct(F.lit("rent").alias("quantity"), F.col("rent_cents").alias("usd_cents"), off("rent_monthly_usd", "rent_cents").alias("off")),
        F.struct(F.lit("deposit").alias("quantity"), F.col("deposit_cents").alias("usd_cents"), off("deposit_usd", "deposit_cents").alias("off")),
    )
    return done.select(F.col("id").alias("listing_id"), F.inline(rows)).where("off").select("listing_id", "quantity", "usd_cents")


def _priced(listings: DataFrame) -> DataFrame:
    return listings.select("id", "price_raw_ko", "rent_monthly_usd", "deposit_usd").where(F.length(F.trim("price_raw_ko")) > 0)


def undecided(listings: DataFrame, unit_rates: DataFrame) -> DataFrame:
    """(listing_id, quantity, usd_cents): the amounts for which several combinations of units fit equally well, with the least of
    them. What an amount of months' rents needs is the rent's decision."""
    done = resolve(_priced(listings), unit_rates)
    rows = F.array(*[F.struct(F.lit(q).alias("quantity"), F.col(f"{q}_cents").alias("usd_cents"), F.col(f"{q}_unique").alias("sure")) for q in ("rent", "deposit")])
    return done.select(F.col("id").alias("listing_id"), F.inline(rows)).where("not sure and usd_cents is not null").select("listing_id", "quantity", "usd_cents")
