"""Small hand-made inputs."""

from __future__ import annotations

import json
from datetime import UTC, datetime

VALID = {"trade_id": "t-7001", "price": "1250.5", "size": "3.25", "side": "sell", "time": "2026-05-02T08:31:07Z"}


def changed(**members) -> dict:
    """The valid record with some members replaced; ``None`` leaves one out."""
    merged = {**VALID, **members}
    return {k: v for k, v in merged.items() if v is not None}


def payload(trade_id, price="100", size="1", side="buy", time="2026-04-10T10:00:00Z", **more) -> str:
    if isinstance(time, datetime):
        time = time.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    return json.dumps({"trade_id": trade_id, "price": str(price), "size": str(size), "side": side, "time": time, **more})


def payloads(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "payload string")


def frame(*trades, channel="market_trades") -> str:
    return json.dumps({"channel": channel, "events": [{"trades": list(trades)}]})


def sorted_rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda row: tuple((v is not None, str(v)) for v in row))
