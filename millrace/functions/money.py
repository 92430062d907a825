"""Money, identifiers and code tables as column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the feeds are defined by.
MONEY_PATTERN = r"^-?\d+(\.\d{1,2})?$"
CURRENCY_BY_COUNTRY = {"LT": "EUR", "PL": "PLN", "SE": "SEK", "GB": "GBP", "US": "USD"}
PHONE_PREFIX_BY_COUNTRY = {"LT": "+3706", "LV": "+3712", "EE": "+3725"}
SCORE_BANDS = [("A", 800), ("B", 650), ("C", 500), ("D", 350)]
LOWEST_BAND = "E"
MAX_RISK_BY_RATING = {"low": 3, "medium": 5, "high": 7}
DEVICES_BY_CHANNEL = {
    "pos": ["pos_terminal"],
    "online": ["web_browser"],
    "web": ["web_browser"],
    "bank_network": ["bank_system"],
    "mobile_app": ["ios", "android"],
}
STREAM_BY_ID_LETTER = {
    "P": "purchase", "R": "refund", "B": "bill_payment", "X": "transfer_out", "S": "salary_in",
}
IBAN_COUNTRY_DIGITS = {"LT": "2129"}
IBAN_LENGTH = {"LT": 20}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_money(text: Column | str, pattern: str = MONEY_PATTERN) -> Column:
    """DECIMAL(18,2); NULL for anything but plain digits with at most two decimals.

    The pattern is needed because a cast alone would round a third decimal instead of refusing it.
    """
    text = _col(text)
    return F.when(text.rlike(pattern), text.try_cast("decimal(18,2)"))


def parse_rate(text: Column | str) -> Column:
    return _col(text).try_cast("decimal(18,4)")


def half_up(amount: Column | str, digits: int = 2) -> Column:
    """Decimal rounding, ties away from zero."""
    return F.round(_col(amount), digits)


def lookup(code: Column | str, table: dict) -> Column:
    """Constant map lookup kept inside the projection; NULL for unknown codes."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(entries, _col(code))


def band(score: Column | str, bands=SCORE_BANDS, lowest: str = LOWEST_BAND) -> Column:
    score = _col(score)
    result = F.when(score.isNull(), F.lit(None).cast("string"))
    for name, limit in bands:
        result = result.when(score >= limit, F.lit(name))
    return result.otherwise(F.lit(lowest))


def suitable(product_risk: Column | str, rating: Column | str, limits: dict = MAX_RISK_BY_RATING) -> Column:
    """Product risk within the customer's limit; NULL when the rating is unknown."""
    return _col(product_risk) <= lookup(rating, limits)


def iban_valid(iban: Column | str, country: str = "LT") -> Column:
    """Length, country and mod-97 check; FALSE for malformed text, NULL for NULL."""
    iban = _col(iban)
    length = IBAN_LENGTH[country]
    well_formed = iban.rlike(rf"^{country}\d{{{length - 2}}}$")
    digits = F.concat(F.substring(iban, 5, length - 4), F.lit(IBAN_COUNTRY_DIGITS[country]),
                      F.substring(iban, 3, 2))
    remainder = digits.try_cast("decimal(38,0)") % F.lit(97)
    return F.when(iban.isNull(), F.lit(None).cast("boolean")).otherwise(
        well_formed & F.coalesce(remainder == 1, F.lit(False)))


def device_allowed(channel: Column | str, device: Column | str) -> Column:
    allowed = F.create_map(*[x for channel_name, devices in DEVICES_BY_CHANNEL.items()
                             for x in (F.lit(channel_name), F.array(*map(F.lit, devices)))])
    return F.coalesce(F.array_contains(F.try_element_at(allowed, _col(channel)), _col(device)), F.lit(False))


def signed_amount(kind: Column | str, amount: Column | str,
                  credits: list[str] = ["refund", "salary_in"]) -> Column:
    """Source amounts are positive; the direction comes from the kind of transaction."""
    amount = _col(amount)
    return F.when(_col(kind).isin(credits), amount).otherwise(-amount)


def null_safe_hash(*columns: str) -> Column:
    """sha256 over all values with NULL distinct from empty text."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
