"""Job settings as plain dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values of the data model: table columns, in contract order.
TABLE_COLUMNS = {
    "users": [
        "id", "has_email", "phone_country", "is_fraudster", "terms_version", "created_date",
        "state", "country", "birth_year", "kyc", "failed_sign_in_attempts",
    ],
    "transactions": [
        "id", "currency", "amount", "state", "created_date", "merchant_category",
        "merchant_country", "entry_method", "user_id", "type", "source",
    ],
    "currency_details": ["ccy", "iso_code", "exponent", "is_crypto"],
    "fx_rates": ["ts", "base_ccy", "ccy", "rate"],
}

# Fixed values of the model: features, label and fill values.
NUMERIC_FEATURES = [
    "created_date", "birth_year", "has_email", "source_minos", "first_success",
    "country_gb", "diff_date", "has_transactions", "cnt_currency",
]
CATEGORICAL_FEATURES = ["terms_version", "type_freq", "state_freq", "kyc"]
LABEL = "is_fraudster"
FILL_TERMS_VERSION = "2000-01-01"
FILL_DEFAULT = -1

# Fixed values of the action rule.
THRESHOLD_AMOUNT = 1000
THRESHOLD_SUSPECT = 0.5
THRESHOLD_ALERT = 0.6
THRESHOLD_LOCK = 0.7
ACTION_LABELS = {
    "LOCK": "LOCK_USER",
    "ALERT": "ALERT_AGENT",
    "BOTH": "BOTH",
    "NOTHING": "NON FRAUDSTER",
}


@dataclass(frozen=True)
class TableSettings:
    """Where a raw table comes from and whether this run loads it."""

    file: str
    extra_file: str = ""
    insert: bool = False
    sep: str = ","


@dataclass(frozen=True)
class ModelSettings:
    """What to train and how."""

    mode: str = "train"
    sampling: str | None = "combine"
    model: str = "RF"
    params: dict = field(
        default_factory=lambda: {"impurity": "entropy", "minInstancesPerNode": 3, "numTrees": 10}
    )
    test_size: float = 0.2
    n_splits: int = 10
    seed: int = 42
    fit_on: str = "train"  # 'all' fits scaler and categories on every row, before the split
    missing_dummy: float = 0.0  # value of a one-hot column whose category was not seen
    absent_dummy: float | None = None  # value of a one-hot column whose category no scored row has
    sparse: bool = False  # categories stay in a table: for columns with any number of values


@dataclass(frozen=True)
class JobSettings:
    """One run: raw files, table warehouse, model folder."""

    tables: dict[str, TableSettings]
    warehouse: str
    model_dir: str
    insert_all: bool = True
    model: ModelSettings = field(default_factory=ModelSettings)

    @staticmethod
    def for_folders(data_dir: str, warehouse: str, model_dir: str, **changes) -> "JobSettings":
        """Default file names under ``data_dir``."""
        tables = {
            "users": TableSettings(f"{data_dir}/train_users.csv", f"{data_dir}/train_fraudsters.csv"),
            "transactions": TableSettings(
                f"{data_dir}/train_transactions.csv", f"{data_dir}/countries.csv"
            ),
            "currency_details": TableSettings(f"{data_dir}/currency_details.csv"),
            "fx_rates": TableSettings(f"{data_dir}/fx_rates.csv", insert=True),
        }
        return JobSettings(tables=tables, warehouse=warehouse, model_dir=model_dir, **changes)
