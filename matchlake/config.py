"""Settings shared by the whole package.

Everything here can be overridden by a parameter of the function that uses it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# --- fixed values: these have to be exactly so for the results to agree ----------
PATCH_PATTERN = r"16\.\d+\.\d+"
SET_PREFIX_PATTERN = r"^(?i)tft\d+_"
SET_PREFIX_ANYWHERE_PATTERN = r"(?i)tft\d+_"
ITEM_PREFIX_PATTERN = r"(?i)tft\d+_item_|(?i)tft\d+_"
SET_NUMBER_PATTERN = r"tft([0-9]*)_.*"
UNIT_SEPARATOR = " | "
ITEM_SEPARATOR = " + "
STATUS_PENDING = "pending"
STATUS_SUCCESS = "success"
STATUS_ERROR = "error"
STATUS_ABANDONED = "abandoned"
NOT_FOUND_MESSAGE = "Partida não encontrada (404)"
DEAD_LETTER_RETRY_MESSAGE = "Reprocessado via DLQ"
DEAD_LETTER_GIVE_UP_MESSAGE = "Abandonado após {} tentativas de DLQ"
FATAL_HTTP_CODES = ("401", "403")
# --- end of fixed values ---------------------------------------------------------

# Where icons are served from and where the game's own images come from. Both are
# deployment settings: pass ``base=`` to the icon functions to use your own.
ASSET_BASE = "https://assets.example.org"
SOURCE_CDN_BASE = "https://cdn.example.org/latest/game"

TOP_PLACEMENT = 4
MIN_TIER_GAMES = 15
MIN_UNIT_GAMES = 10
MIN_COMP_GAMES = 3
MIN_ITEM_GAMES = 5
MIN_ITEMS = 2
COMP_SLOTS = 9
ITEM_SLOTS = 3

MATCHES_PER_PLAYER = 20
HOURS_BACK = 24
RANKED_QUEUE = 1100
BATCH_SIZE = 50
LADDER_LIMIT = 200
RETENTION_DAYS = 90

MAX_RETRIES = 3
MAX_DLQ_ATTEMPTS = 2
MAX_DELIVERIES = 5
ERROR_TEXT_LIMIT = 500

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Groups are cut to their first rows before the shuffle, however many rows are wanted.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings all operators rely on."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for staged tables that every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``; where that is unset it lies below the
    warehouse folder, which executors share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return folder.rstrip("/")
