"""The feeds: where they land, how often, and the columns, types and code values their contract fixes."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

CHANGE = {"op": "string", "change_seq": "bigint", "change_ts": "timestamp"}


@dataclass(frozen=True)
class Feed:
    source: str
    entity: str
    cadence: str                                    # daily | business_day | monthly
    kind: str = "events"                            # changes | snapshot | events
    keys: tuple[str, ...] = ()
    columns: dict[str, str] = field(default_factory=dict, hash=False)   # name -> Silver type
    amount: str | None = None
    currency: str | None = None
    first_day_offset: int = 0                       # business days after the start before the first batch

    def under(self, root: str) -> str:
        """This feed's folder below `root`: every area keeps source above entity."""
        return "/".join((root.rstrip("/"), self.source, self.entity))


# The twelve feeds, their wire columns and the type each becomes.
FEEDS = [
    Feed("core_banking", "customers", "daily", "changes", ("customer_id",), {
        **CHANGE, "customer_id": "string", "old_customer_id": "string", "first_name": "string",
        "last_name": "string", "email": "string", "phone": "string", "date_of_birth": "date",
        "city": "string", "country": "string", "segment": "string", "kyc_status": "string",
        "risk_rating": "string", "customer_since": "date"}),
    Feed("core_banking", "accounts", "daily", "changes", ("account_id",), {
        **CHANGE, "account_id": "string", "account_type": "string", "status": "string",
        "currency": "string", "open_date": "date", "credit_limit": "decimal(18,2)"}),
    Feed("core_banking", "account_holders", "daily", "changes", ("account_id", "customer_id"), {
        **CHANGE, "account_id": "string", "customer_id": "string", "role": "string"}),
    Feed("acquirer", "merchants", "daily", "changes", ("merchant_id",), {
        **CHANGE, "merchant_id": "string", "merchant_name": "string", "mcc": "string",
        "category": "string", "city": "string", "country": "string"}),
    Feed("reference", "billers", "daily", "snapshot", ("biller_id",), {
        "biller_id": "string", "biller_name": "string", "bill_type": "string"}),
    Feed("reference", "invest_products", "daily", "snapshot", ("isin",), {
        "isin": "string", "product_name": "string", "asset_class": "string", "risk_level": "int",
        "currency": "string"}),
    Feed("reference", "fx_rates", "business_day", "events", ("rate_date", "currency"), {
        "rate_date": "date", "base_currency": "string", "currency": "string",
        "rate": "decimal(18,4)", "source": "string"}),
    Feed("kyc_vendor", "kyc_checks", "daily", "events", ("kyc_check_id",), {
        "kyc_check_id": "string", "check_ts": "timestamp", "customer_id": "string",
        "check_type": "string", "result": "string", "provider": "string"}, first_day_offset=1),
    Feed("payments", "transactions", "daily", "events", ("transaction_id",), {
        "transaction_id": "string", "event_ts": "timestamp", "transaction_type": "string",
        "customer_id": "string", "account_id": "string", "payment_method": "string",
        "channel": "string", "merchant_id": "string", "biller_id": "string", "bill_reference": "string",
        "due_date": "date_or_instant", "counterparty_iban": "string", "original_transaction_id": "string",
        "amount": "decimal(18,2)", "currency": "string", "status": "string"},
        amount="amount", currency="currency"),
    Feed("crm", "support_cases", "daily", "changes", ("case_id",), {
        **CHANGE, "case_id": "string", "customer_id": "string", "channel": "string", "reason": "string",
        "status": "string", "opened_ts": "timestamp", "first_response_ts": "timestamp",
        "resolved_ts": "timestamp"}, first_day_offset=1),
    Feed("custodian", "holdings", "business_day", "events", ("business_date", "customer_id", "isin"), {
        "business_date": "date", "customer_id": "string", "isin": "string", "units": "decimal(18,4)",
        "price": "decimal(18,4)", "market_value": "decimal(18,2)", "currency": "string"},
        amount="market_value", currency="currency"),
    Feed("credit_bureau", "credit_scores", "monthly", "events", ("report_month", "customer_id"), {
        "report_month": "string", "customer_id": "string", "score": "int", "risk_band": "string",
        "open_credit_lines": "int", "days_past_due_max": "int", "bureau": "string"}),
]
BY_ENTITY = {f.entity: f for f in FEEDS}
# Delivery order of the sources, fields added by later contract versions, renamed fields.
SOURCE_ORDER = ["core_banking", "acquirer", "reference", "kyc_vendor", "payments", "crm", "custodian",
                "credit_bureau"]
ADDED_FIELDS = {("transactions", "1.1"): {"device_type": "string"}}
RENAMED_FIELDS = {"transactions": {"merchant_id": ["merchant_ref"]}}

# Code values and allowed combinations of the contract.
DOMAINS = {
    "customers": {"op": ["I", "U", "D"], "country": ["LT", "LV", "EE"],
                  "segment": ["mass", "affluent", "premium"],
                  "kyc_status": ["verified", "pending", "expired"], "risk_rating": ["low", "medium", "high"]},
    "accounts": {"op": ["I", "U", "D"], "account_type": ["current", "savings", "credit_card"],
                 "status": ["active", "closed"]},
    "account_holders": {"op": ["I", "U", "D"], "role": ["primary", "joint"]},
    "merchants": {"op": ["I", "U", "D"], "country": ["LT", "PL", "SE", "GB", "US"]},
    "billers": {"bill_type": ["utility", "telecom", "internet", "insurance", "rent"]},
    "fx_rates": {"base_currency": ["EUR"], "currency": ["GBP", "PLN", "SEK", "USD"]},
    "kyc_checks": {"check_type": ["identity_document", "periodic_review", "re_verification"],
                   "result": ["pass", "fail", "review"]},
    "transactions": {
        "transaction_type": ["purchase", "refund", "bill_payment", "transfer_out", "salary_in"],
        "payment_method": ["debit_card", "credit_card", "mobile_wallet", "bank_transfer"],
        "channel": ["pos", "online", "mobile_app", "web", "bank_network"],
        "currency": ["EUR", "PLN", "SEK", "GBP", "USD"], "status": ["completed", "declined"]},
    "support_cases": {
        "op": ["I", "U"], "channel": ["chat", "phone", "email"],
        "reason": ["declined_payment", "card_issue", "login_problem", "fee_question", "transfer_status"],
        "status": ["opened", "in_progress", "resolved"]},
    "credit_scores": {"risk_band": ["A", "B", "C", "D", "E"]},
}
#: Feeds with fields that only some kinds of row use, and the column that names the kind.
CROSS_FIELDS = {"transactions": ("transaction_type",)}
OUTGOING = ["purchase", "bill_payment", "transfer_out"]
ACCOUNT_TYPES_BY_METHOD = {
    "credit_card": ["credit_card"], "debit_card": ["current"], "bank_transfer": ["current"],
    "mobile_wallet": ["current", "credit_card"],
}
CASE_LIFECYCLE = ["opened", "in_progress", "resolved"]
PERSONAL_COLUMNS = ["first_name", "last_name", "email", "phone", "date_of_birth", "counterparty_iban"]


def contract_columns(feed: Feed, version: str = "1.0") -> dict[str, str]:
    """Columns of one approved contract version; later additions only from their version on."""
    columns = dict(feed.columns)
    for (entity, since), added in ADDED_FIELDS.items():
        if entity == feed.entity and version >= since:
            columns.update(added)
    return columns


def feed_table(spark: SparkSession, feeds: list[Feed] = FEEDS) -> DataFrame:
    """The registry as a small table: one row per feed."""
    rank = {s: i for i, s in enumerate(SOURCE_ORDER)}
    rows = [(f.source, f.entity, f.cadence, f.under("").lstrip("/"), "bronze." + f.entity, f.first_day_offset,
             rank.get(f.source, len(rank))) for f in feeds]
    return spark.createDataFrame(
        rows, "source string, entity string, cadence string, landing_subpath string, bronze_table string, "
              "first_day_offset int, source_rank int")
