"""Job settings: `key=value` files or mappings. Nothing secret has a default."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

# Keys and the limits that apply where a key is absent.
DB_URL, DB_USER, DB_PASSWORD, DB_DRIVER = "db.url", "db.username", "db.password", "db.driver"
BATCH_SIZE, BATCH_INTERVAL = "db.batch_size", "db.batch_interval"
BROKER, SALES_TOPIC, RATES_TOPIC = "kafka_broker", "transactions_topic", "currency_topic"
DEFAULTS = {
    BATCH_SIZE: "1000",
    BATCH_INTERVAL: "200",
    SALES_TOPIC: "sales_transactions",
    RATES_TOPIC: "currencyExchange",
}


@dataclass(frozen=True)
class Settings:
    values: Mapping[str, str] = field(default_factory=dict)

    def get(self, key: str) -> str | None:
        """The value, its default, or None."""
        return self.values.get(key, DEFAULTS.get(key))

    def require(self, key: str) -> str:
        value = self.get(key)
        if value is None:
            raise KeyError(f"setting {key!r} is missing")
        return value

    @property
    def trigger(self) -> dict[str, str]:
        """The flush interval, as a streaming trigger."""
        return {"processingTime": f"{int(self.require(BATCH_INTERVAL))} milliseconds"}

    @classmethod
    def from_file(cls, path: str, **overrides: str) -> Settings:
        """Read a properties file; a missing file is an error."""
        lines = (line.strip() for line in Path(path).read_text().splitlines())
        pairs = (line.split("=", 1) for line in lines if "=" in line and line[0] not in "#!")
        return cls({key.strip(): value.strip() for key, value in pairs} | overrides)
