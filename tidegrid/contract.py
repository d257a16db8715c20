"""Dataset contracts: what a file must look like and how its columns become a typed series."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import asdict, dataclass, field
from pathlib import Path

LOCALES = ("de", "en")
FEATURES = ("hour", "day_of_week", "month", "is_weekend", "hour_sin", "hour_cos", "price_lag_24h", "price_lag_48h")
TARGET = "price_eur_mwh"
#: strptime directives and the letters that Spark's datetime patterns have for them (fixed values).
DIRECTIVES = {"%Y": "yyyy", "%m": "MM", "%d": "d", "%b": "MMM", "%B": "MMMM", "%H": "H", "%I": "h", "%M": "mm", "%S": "ss", "%p": "a", "%z": "XX", "%y": "yy"}


def java_pattern(fmt: str) -> str:
    """The Spark datetime pattern of a strptime format; unknown directives are refused."""
    out, i = [], 0
    while i < len(fmt):
        two = fmt[i : i + 2]
        if two == "%%":
            out.append("'%'")
            i += 2
        elif two[0] == "%":
            if two not in DIRECTIVES:
                raise ValueError(f"unknown datetime directive {two!r}")
            out.append(DIRECTIVES[two])
            i += 2
        else:
            c = fmt[i]
            out.append("''" if c == "'" else f"'{c}'" if c.isalpha() else c)
            i += 1
    return "".join(out)


@dataclass(frozen=True)
class DatasetContract:
    """One dataset: its file, ordered header, time columns, measures and rules."""

    name: str
    expected_columns: tuple[str, ...]
    timestamp_columns: tuple[str, ...]
    timestamp_format: str
    numeric_columns: dict[str, str]
    path: str = ""
    delimiter: str = ";"
    timezone: str = "Europe/Berlin"
    locale: str = "de"
    dst_policy: str = "strict"
    nonnegative: tuple[str, ...] = ()
    nullable: tuple[str, ...] = ()
    max_file_bytes: int | None = 64 * 1024 * 1024

    def __post_init__(self):
        missing = {*self.timestamp_columns, *self.numeric_columns} - {*self.expected_columns}
        if missing:
            raise ValueError(f"{self.name}: parsed columns that the header lacks: {sorted(missing)}")
        if self.locale not in LOCALES:
            raise ValueError(f"{self.name}: locale must be one of {LOCALES}")
        if len(set(self.expected_columns)) != len(self.expected_columns):
            raise ValueError(f"{self.name}: repeated header columns")
        for rule in ("nonnegative", "nullable"):
            if unknown := {*getattr(self, rule)} - {*self.numeric_columns.values()}:
                raise ValueError(f"{self.name}: {rule} names unknown measures {sorted(unknown)}")
        java_pattern(self.timestamp_format)

    @property
    def measures(self) -> list[str]:
        return list(self.numeric_columns.values())

    @classmethod
    def of(cls, name: str, spec: dict) -> DatasetContract:
        return cls(**_chosen(spec, cls) | {"name": name})


@dataclass(frozen=True)
class ModelContract:
    features: tuple[str, ...]
    candidates: tuple[dict, ...] = ({"n_estimators": 100, "max_depth": 3},)
    train_fraction: float = 0.6
    validation_fraction: float = 0.2
    purge_hours: int = 24
    max_rows: int = 200_000

    def __post_init__(self):
        if unknown := {*self.features} - {*FEATURES}:
            raise ValueError(f"features not known at forecast time: {sorted(unknown)}")


@dataclass(frozen=True)
class Contract:
    datasets: dict[str, DatasetContract]
    model: ModelContract
    source: dict = field(default_factory=dict, compare=False)

    @property
    def sha256(self) -> str:
        return hashlib.sha256(json.dumps(self.source, sort_keys=True).encode()).hexdigest()


PROFILE = ("consumption", "generation", "price")


def _chosen(spec: dict, kind: type) -> dict:
    """What of a JSON object belongs to a dataclass, lists as tuples."""
    return {k: tuple(v) if isinstance(v, list) else v for k, v in spec.items() if k in kind.__dataclass_fields__}


def violations(datasets: dict[str, DatasetContract], profile: tuple[str, ...] | None) -> list[str]:
    """The rules across datasets that these break."""
    owners: dict[str, list[str]] = {}
    for name, dataset in datasets.items():
        for measure in dataset.measures:
            owners.setdefault(measure, []).append(name)
    found = [f"measure {m} is mapped more than once: {', '.join(own)}" for m, own in owners.items() if len(own) > 1]
    found += [f"measure {m!r} must be of small letters, digits and underscores" for m in owners if not re.fullmatch("[a-z][a-z0-9_]*", m)]
    if profile is not None:
        found += [f"dataset {name} is {'not known' if name in datasets else 'required'}" for name in sorted({*datasets} ^ {*profile})]
        if "price" not in owners.get(TARGET, []):
            found.append(f"{TARGET} must be a measure of the price dataset")
    return found


def parse(source: dict, profile: tuple[str, ...] | None = PROFILE) -> Contract:
    """A validated contract; all broken rules are told at once. ``profile``: the dataset names required; None allows any."""
    datasets = {name: DatasetContract.of(name, spec) for name, spec in source["datasets"].items()}
    if found := violations(datasets, profile):
        raise ValueError("; ".join(found))
    return Contract(datasets, ModelContract(**{"features": FEATURES} | _chosen(source.get("model", {}), ModelContract)), source)


def load(path: str) -> Contract:
    return parse(json.loads(Path(path).read_text(encoding="utf-8")))


def safe_header(name: str) -> str:
    """Small letters and digits, other runs as one underscore, none at the ends."""
    return re.sub("[^a-z0-9]+", "_", name.lower()).strip("_")


def bootstrap(name: str, path: str, delimiter: str = ";", **settings) -> dict:
    """A draft of a dataset's contract from a local file's header, with the file's checksum.

    Only ever called explicitly; the first column is taken for the time, columns after the second as measures.
    """
    raw = Path(path).read_bytes()
    header = raw.decode("utf-8-sig").splitlines()[0].split(delimiter)
    spec = {"path": path, "delimiter": delimiter, "expected_columns": header, "timestamp_columns": header[:1], "timestamp_format": "%b %d, %Y %I:%M %p"}
    spec |= {"numeric_columns": {h: safe_header(h) for h in header[2:]}, "source_sha256": hashlib.sha256(raw).hexdigest()} | settings
    DatasetContract.of(name, spec)
    return spec


def as_dict(contract: DatasetContract) -> dict:
    return asdict(contract)
