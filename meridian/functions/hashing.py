"""Stable ids. Column forms hash text that Spark can build; canonical JSON and signatures are plain Python."""

from __future__ import annotations

import hashlib
import hmac
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.text import col, normalise


def _id(prefix: str, digits: int, outlet, alias) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("\n", col(outlet), col(alias)), 256), 1, digits))


def story_id(outlet, alias) -> Column:
    return _id("st_", 16, outlet, alias)


def cluster_id(outlet, alias) -> Column:
    return _id("nf_", 12, outlet, alias)


def text_hash(text) -> Column:
    """Of the text with single spaces, so that a reflowed paragraph changes nothing; null for no text."""
    return F.sha2(F.nullif(normalise(text), F.lit("")), 256)


def files_hash(files, digests) -> Column:
    """An aggregate over (file, sha256): 16 digits, whatever the order of the rows."""
    entries = F.sort_array(F.collect_list(F.struct(col(files).alias("f"), col(digests).alias("d"))))
    return F.substring(F.sha2(F.array_join(F.transform(entries, lambda x: F.concat_ws(":", x["f"], x["d"])), "|"), 256), 1, 16)


def canonical_json(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def digest(value, digits: int = 64) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()[:digits]


def snapshot_id(body: dict) -> str:
    """Changes with the content only: the id itself and the build time are left out."""
    return f"snap_{digest({k: v for k, v in body.items() if k not in ('snapshotId', 'generatedAt')}, 16)}"


def item_hash(material: list) -> str:
    return digest(material, 32)


def text_item_hash(text) -> Column:
    """item_hash() of a list with one string, for a column of strings without control characters."""
    quoted = F.replace(F.replace(col(text), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.substring(F.sha2(F.concat(F.lit('["'), quoted, F.lit('"]')), 256), 1, 32)


class ConfigHashes:
    """Hashes of the stages' settings, each over its own and those of the stages that it builds on."""

    DEPENDS = {"extract": (), "resolve": ("extract",), "cluster": ("extract", "resolve"), "verify": ("extract", "resolve"), "placement": ("extract", "resolve", "verify")}

    def __init__(self, settings: dict[str, dict]):
        self.settings = settings

    def of(self, stage: str) -> str:
        return digest({"stage": stage, "settings": self.settings.get(stage, {}), "on": [self.of(s) for s in self.DEPENDS[stage]]}, 16)


def canonical(c) -> Column:
    """canonical_json() of JSON text; null for what is none."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def one(text):
            try:
                return canonical_json(json.loads(text))
            except (ValueError, TypeError, RecursionError):
                return None

        return texts.map(one)

    return run(col(c))


def config_hashes(configs: DataFrame, settings: dict[str, str]) -> DataFrame:
    """configs with a column <stage>_hash for each stage: ConfigHashes.of() of each row.

    settings names, by stage, the column that holds the stage's settings as JSON text; a stage without one, a null, and what is no JSON
    count as empty settings.
    """
    read = configs.withColumns({f"_{stage}": F.coalesce(canonical(c), F.lit("{}")) for stage, c in settings.items()})
    for stage, on in ConfigHashes.DEPENDS.items():
        below = F.concat_ws(",", *(F.concat(F.lit('"'), F.col(f"{s}_hash"), F.lit('"')) for s in on))
        own = F.col(f"_{stage}") if stage in settings else F.lit("{}")
        text = F.concat(F.lit('{"on":['), below, F.lit('],"settings":'), own, F.lit(f',"stage":"{stage}"}}'))
        read = read.withColumn(f"{stage}_hash", F.substring(F.sha2(text, 256), 1, 16))
    return read.drop(*(f"_{stage}" for stage in settings))


def signing_text(prefix: str, timestamp_ms: int, body: bytes) -> str:
    return "\n".join([prefix, str(timestamp_ms), hashlib.sha256(body).hexdigest()])


def sign(secret: str, text: str) -> str:
    return hmac.new(secret.encode(), text.encode(), hashlib.sha256).hexdigest()


def signature(secret: str, text) -> Column:
    """sign() of a column: HMAC-SHA256 from two rounds of SHA-256 over padded keys."""
    key = secret.encode()
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    pad = lambda byte: F.lit(bytes(b ^ byte for b in key))
    inner = F.unhex(F.sha2(F.concat(pad(0x36), F.encode(col(text), "UTF-8")), 256))
    return F.sha2(F.concat(pad(0x5C), inner), 256)


def verified(secret: str, text: str, signature: str, sent_s: float, now_s: float, skew_s: float = 300) -> bool:
    """Is the signature right and its time close enough?"""
    return abs(now_s - sent_s) <= skew_s and hmac.compare_digest(sign(secret, text), signature)


def is_verified(secret: str, text, given, sent_s, now_s, skew_s: float = 300) -> Column:
    """verified() of columns; what is missing is not verified."""
    fresh = F.abs(col(now_s) - col(sent_s)) <= skew_s
    return F.coalesce((signature(secret, text) == col(given)) & fresh, F.lit(False))
