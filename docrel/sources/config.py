"""Settings from INI files: the target database and the document stores, by shard and replica set."""

from __future__ import annotations

import configparser
import re
from dataclasses import dataclass


@dataclass(frozen=True)
class StoreSettings:
    host: str
    port: int
    database: str
    user: str = ""
    password: str = ""
    options: str = ""
    ssl: bool = False


@dataclass(frozen=True)
class TargetSettings:
    host: str
    port: int
    database: str
    user: str
    password: str
    schema: str = ""
    prefix: str = ""


def read(text: str) -> configparser.ConfigParser:
    parser = configparser.ConfigParser(interpolation=None)
    parser.read_string(text)
    return parser


def store_settings(config: configparser.ConfigParser, section: str) -> StoreSettings:
    """A section's keys are named after the section; ssl may be missing."""
    own = config[section]
    get = lambda k, default="": own.get(f"{section}-{k}", own.get(k, default))
    return StoreSettings(get("host"), int(get("port") or 27017), get("dbname") or get("db"), get("user"), get("pass"), get("params"), get("ssl").lower() in ("1", "true", "yes"))


def target_settings(config: configparser.ConfigParser, section: str = "psql") -> TargetSettings:
    own = config[section]
    get = lambda k, default="": own.get(f"{section}-{k}", own.get(k, default))
    return TargetSettings(get("host"), int(get("port") or 5432), get("dbname") or get("db"), get("user"), get("pass"), get("schema-name") or get("schema"), get("table-prefix"))


def sections(config: configparser.ConfigParser, base: str) -> list[str]:
    """Sections that are ``base`` or extend it by a dash."""
    return [s for s in config.sections() if s == base or s.startswith(f"{base}-")]


def structure(names: list[str], base: str) -> dict[str, dict[str, str]]:
    """``{shard: {replica: section}}`` of names such as base, base-rs1, base-shard1, base-shard1-rs2."""
    out: dict[str, dict[str, str]] = {}
    for name in names:
        m = re.fullmatch(re.escape(base) + r"(?:-(shard[^-]*))?(?:-(rs[^-]*))?", name)
        if m:
            out.setdefault(m[1] or "", {})[m[2] or ""] = name
    return out


def replicas(config: configparser.ConfigParser, base: str = "mongo-oplog") -> dict[str, list[StoreSettings]]:
    """The hosts of each shard; a single store or replica set is the shard named by ``base``."""
    found = structure(sections(config, base), base)
    return {f"{base}-{shard}" if shard else base: [store_settings(config, s) for _, s in sorted(own.items())] for shard, own in found.items()}


def store_uri(settings: list[StoreSettings]) -> str:
    """A URI over all hosts of a replica set, with the user and options of the first."""
    first = settings[0]
    user = f"{first.user}:{first.password}@" if first.user else ""
    hosts = ",".join(f"{s.host}:{s.port}" for s in settings)
    options = "&".join(x for x in (first.options, "ssl=true" if first.ssl else "") if x)
    return f"mongodb://{user}{hosts}/{first.database}" + (f"?{options}" if options else "")


def value(config: configparser.ConfigParser, path: str) -> str:
    """``section:key``, or a key under any section."""
    section, _, key = path.rpartition(":")
    if section:
        return config[section][key]
    return next(config[s][key] for s in config.sections() if key in config[s])
