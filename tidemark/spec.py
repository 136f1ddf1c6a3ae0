"""Table specifications and the fixed configuration values of the change-feed model.

A ``TableSpec`` is plain configuration: target column names (lower case), Spark
types, primary key, optional VARCHAR limits and per-feed vendor renames.  No DDL
is parsed; callers build specs from a ``StructType``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the behaviour being reproduced, so they are
# stated as plain text, in their natural order, and not derived.
# ---------------------------------------------------------------------------

# Change flags: add, update, delete.
FLAG_ADD = "A"
FLAG_UPDATE = "O"
FLAG_DELETE = "D"
UPSERT_FLAGS = ("A", "O")

# Text values that mean "no value" (compared after trim, case-insensitive).
NULL_TOKENS = ("nan", "none", "<na>")

# A record whose message/error text contains one of these is a status
# envelope, not data.
MESSAGE_KEYS = ("Message", "message", "Error", "error")
MESSAGE_TOKENS = ("no data found", "no record found", "error")

# Wrapper text around line-per-record payloads.
ENVELOPE_PREFIX = '{"Table":['
ENVELOPE_SUFFIX = "]}"
BRACKET_ONLY_LINES = ("{", "}", "]}", "]", "[", "[]", "[]}")

# Run statuses.
STATUS_STARTED = "STARTED"
STATUS_SUCCESS = "SUCCESS"
STATUS_NO_CONTENT = "NO_CONTENT"
STATUS_API_ERROR = "API_ERROR"
STATUS_EMPTY = "EMPTY"
STATUS_VALIDATION_FAILED = "VALIDATION_FAILED"
STATUS_TABLE_NOT_FOUND = "TABLE_NOT_FOUND"
STATUS_FAILED = "FAILED"
STATUS_ABANDONED = "ABANDONED"
STATUS_WARNINGS = "WARNINGS"
# A run for a (feed, date) counts as done when it has one of these.
DONE_STATUSES = ("SUCCESS", "STARTED", "NO_CONTENT")
# A run counts as succeeded in a run summary when it has one of these.
SUCCEEDED_STATUSES = ("SUCCESS", "NO_CONTENT")
# Transport outcomes: no data, and errors of the feed's service.
NO_CONTENT_CODE = 204
API_ERROR_CODES = (403, 404)
# Findings about a feed.
MESSAGE_NO_ROWS = "{table}: DataFrame is empty"
MESSAGE_NO_FLAG = "{table}: column 'flag' is missing from payload; defaulting all rows to flag='A'"
MESSAGE_NO_KEY = "{table}: missing PK columns: {columns}"
ABANDON_MESSAGE = "Service restarted or terminated unexpectedly"

# Business date: runs before this local hour belong to the previous day.
BUSINESS_DAY_CUTOFF_HOUR = 6
DEFAULT_TIMEZONE = "Asia/Kolkata"
RUN_LOG_RETENTION_DAYS = 30

# Report file names: {fincode}-{type}-{yyyymm}.pdf, any case; year folders.
REPORT_FILE_PATTERN = r"(?i)^(\d+)-([a-zA-Z0-9]+)-(\d{6})\.pdf$"
YEAR_FOLDER_PATTERN = r"^\d{4}$"
LOCAL_LOCATION_PREFIX = "local://"

# Error text kept in reports and run logs is cut to these lengths.
PARSE_ERROR_TEXT_LIMIT = 180
LOAD_ERROR_TEXT_LIMIT = 200
FILE_ERROR_TEXT_LIMIT = 500

# Feed groups.
COMPANY_MASTER_FEEDS = ("Company_master",)
RESULTS_FEEDS = ("Resultsf_IND_Ex1", "Resultsf_IND_Cons_Ex1")
EOD_FEEDS = (
    "RelatedParties_Transaction", "RelatedParties_Transaction_Cons",
    "Industrymaster_Ex1", "Housemaster", "Stockexchangemaster", "Registrarmaster",
    "Shp_catmaster_2", "Companyaddress", "Board", "Registrardata", "Complistings",
    "Finance_bs", "Finance_cons_bs", "Finance_pl", "Finance_cons_pl", "Finance_cf",
    "Finance_cons_cf", "Finance_fr", "Finance_cons_fr", "company_equity",
    "company_equity_cons", "Shpsummary", "Shp_details", "Monthlyprice", "Nse_Monthprice",
)

# Standalone feed -> consolidated feed run after it.
CONSOLIDATED_PAIRS = {
    "Finance_bs": "Finance_cons_bs",
    "Finance_pl": "Finance_cons_pl",
    "Finance_cf": "Finance_cons_cf",
    "Finance_fr": "Finance_cons_fr",
    "company_equity": "company_equity_cons",
    "RelatedParties_Transaction": "RelatedParties_Transaction_Cons",
}

# Primary keys by table (lower-case table name).
PRIMARY_KEYS = {
    "company_master": ["fincode"],
    "industrymaster_ex1": ["ind_code"],
    "housemaster": ["house_code"],
    "stockexchangemaster": ["stk_id"],
    "registrarmaster": ["registrarno"],
    "shp_catmaster_2": ["shp_catid"],
    "companyaddress": ["fincode"],
    "board": ["fincode", "yrc", "serialno", "dirtype_id"],
    "registrardata": ["fincode", "registrarno"],
    "complistings": ["fincode", "stk_id"],
    "finance_bs": ["fincode", "year_end", "type"],
    "finance_cons_bs": ["fincode", "year_end", "type"],
    "finance_pl": ["fincode", "year_end", "type"],
    "finance_cons_pl": ["fincode", "year_end", "type"],
    "finance_cf": ["fincode", "year_end", "type"],
    "finance_cons_cf": ["fincode", "year_end", "type"],
    "finance_fr": ["fincode", "year_end", "type"],
    "finance_cons_fr": ["fincode", "year_end", "type"],
    "resultsf_ind_ex1": ["fincode", "result_type", "date_end"],
    "resultsf_ind_cons_ex1": ["fincode", "result_type", "date_end"],
    "company_equity": ["fincode"],
    "company_equity_cons": ["fincode"],
    "shpsummary": ["fincode", "date_end"],
    "shp_details": ["fincode", "date_end", "srno"],
    "monthlyprice": ["fincode", "month", "year"],
    "nse_monthprice": ["fincode", "month", "year"],
    "relatedparties_transaction": ["fincode", "year_end", "srno"],
    "relatedparties_transaction_cons": ["fincode", "year_end", "srno"],
    "digital_reports": ["fincode", "report_type", "year_end"],
    "ingestion_run_logs": ["id"],
}

# Vendor column name (normalised) -> schema column name, per feed (lower case).
COLUMN_RENAMES = {
    "finance_bs": {"outstanding_forward_exchange_contract": "outstanding_forward_exchange_contra"},
    "finance_cons_bs": {"outstanding_forward_exchange_contract": "outstanding_forward_exchange_contra"},
    "resultsf_ind_ex1": {
        "interest coverage ratio": "interest_coverage_ratio",
        "inventory turnover ratio": "inventory_turnover_ratio",
        "dividend per share": "dividend_per_share",
        "deebtor turnover ratio": "debtor_turnover_ratio",
        "debtor turnover ratio": "debtor_turnover_ratio",
        "debt/equity ratio": "debt_equity_ratio",
        "dividend payout ratio": "dividend_payout_ratio",
        "return on capital employed": "return_on_capital_employed",
    },
    "resultsf_ind_cons_ex1": {
        "interest coverage ratio": "interest_coverage_ratio",
        "inventory turnover ratio": "inventory_turnover_ratio",
        "dividend per share": "dividend_per_share",
        "deebtor turnover ratio": "debtor_turnover_ratio",
        "debtor turnover ratio": "debtor_turnover_ratio",
        "debt/equity ratio": "debt_equity_ratio",
        "dividend payout ratio": "dividend_payout_ratio",
        "return on capital employed": "return_on_capital_employed",
    },
}

# ---------------------------------------------------------------------------


def norm_name(name: str) -> str:
    """Column-name normalisation: trim, lower case."""
    return str(name).strip().lower()


@dataclass(frozen=True)
class TableSpec:
    """Target table: columns (lower case, declared order), key, limits, renames."""

    name: str
    schema: T.StructType
    pk: tuple[str, ...]
    lengths: dict[str, int] = field(default_factory=dict)
    renames: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        names = [f.name for f in self.schema.fields]
        if any(n != norm_name(n) for n in names):
            raise ValueError(f"{self.name}: spec column names must be trimmed lower case")
        missing = [k for k in self.pk if k not in names]
        if missing:
            raise ValueError(f"{self.name}: PK columns not in schema: {missing}")

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def has_flag(self) -> bool:
        return "flag" in self.columns

    def dtype(self, col: str) -> T.DataType:
        return self.schema[col].dataType

    @classmethod
    def of(cls, name: str, schema: T.StructType | str, pk=None, lengths=None, renames=None) -> "TableSpec":
        if isinstance(schema, str):
            schema = T._parse_datatype_string(schema)
        schema = T.StructType([T.StructField(norm_name(f.name), f.dataType, True) for f in schema.fields])
        if pk is None:
            pk = PRIMARY_KEYS.get(name.lower())
            if pk is None:
                raise ValueError(f"No primary key configured for table={name}")
        if renames is None:
            renames = COLUMN_RENAMES.get(name.lower(), {})
        return cls(name, schema, tuple(norm_name(k) for k in pk), dict(lengths or {}), dict(renames))

    @classmethod
    def from_table(cls, spark, table: str, name: str | None = None, pk=None) -> "TableSpec":
        """Columns, types and VARCHAR limits of an existing table of the session's
        catalogue; key and renames are those of the fixed values for its name."""
        fields, lengths = [], {}
        for f in spark.table(table).schema.fields:
            declared = str((f.metadata or {}).get("__CHAR_VARCHAR_TYPE_STRING", "")).lower()
            if declared.startswith(("varchar(", "char(")):
                lengths[norm_name(f.name)] = int(declared.split("(")[1].rstrip(")"))
            fields.append(T.StructField(f.name, f.dataType))
        return cls.of(name or table.rsplit(".", 1)[-1], T.StructType(fields), pk, lengths)


# Report-file manifest table.
MANIFEST_SPEC = TableSpec.of(
    "digital_reports",
    T.StructType([
        T.StructField("fincode", T.IntegerType()),
        T.StructField("report_type", T.StringType()),
        T.StructField("year_end", T.IntegerType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("azure_blob_url", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("downloaded_at", T.TimestampType()),
    ]),
    lengths={"report_type": 5, "file_name": 255, "azure_blob_url": 512, "status": 20},
)

# Feed groups, one row each: (feed_name, group).
def feed_groups_rows() -> list[tuple[str, str]]:
    return ([(f, "company_master") for f in COMPANY_MASTER_FEEDS] + [(f, "results") for f in RESULTS_FEEDS]
            + [(f, "eod") for f in EOD_FEEDS])
