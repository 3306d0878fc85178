"""Declarative job spec: key aliases, key combinations, targets, tie-break order.

The spec is small metadata that lives on the driver. It is read once (from
Python values or a JSON file) and turned into static Column expressions; no
data passes through it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from typing import Iterable, Sequence

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference job's configuration and code
# for identical results; they are stated here in their original order.
#
# Header aliases, in priority order: (feed header, canonical key column).
DEFAULT_ALIASES: tuple[tuple[str, str], ...] = (
    ("Airline PNR/Prov. Booking", "PNR_Number"),
    ("Airline PNR", "PNR_Number"),
    ("pnrnumber", "PNR_Number"),
    ("pnr number", "PNR_Number"),
    ("Airline Code", "Airline_Code"),
    ("airlinecode", "Airline_Code"),
    ("Sector", "Travel_Sector"),
    ("trvael sector", "Travel_Sector"),
    ("travelsector", "Travel_Sector"),
    ("travel sector", "Travel_Sector"),
)
# Key combinations, tried in order.
DEFAULT_KEY_COMBINATIONS: tuple[tuple[str, ...], ...] = (
    ("PNR_Number", "Airline_Code", "Travel_Sector"),
)
# Target columns in output order, with their display names.
DEFAULT_TARGETS: tuple[tuple[str, str], ...] = (
    ("Taxable_Amount", "Taxable_Amount"),
    ("NonTaxable_Amount", "NonTaxable_Amount"),
    ("Cgst_Total", "CGST"),
    ("Sgst_Total", "SGST"),
    ("Igst_Total", "IGST"),
    ("Booking_Date", "Booking Date"),
    ("GST_Name", "GST Name"),
    ("GST_Number", "GST Number"),
    ("Invoice_Number", "Invoice_Number"),
    ("Invoice_Total_GST", "TOTAL GST"),
    ("Airline_Gst_Number", "Airline GST Number"),
    ("Airline_Gst_Name", "Airline GST Name"),
)
# Supported feed extensions, in discovery order.
DEFAULT_EXTENSIONS: tuple[str, ...] = (".xlsx", ".xls", ".csv")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class EnrichSpec:
    """What to join on and what to append.

    ``aliases``          ordered (feed header, canonical key) pairs (R1, R2)
    ``key_combinations`` ordered canonical key tuples; the first fully present wins (R5)
    ``targets``          ordered (reference column, display name) pairs (R12, R14)
    ``order_by``         tie-break among reference rows sharing a key (R9, H8);
                         strings are ascending NULLS FIRST, a leading ``-`` means descending
    ``coalesce_aliases`` if True, take the first non-empty alias cell instead of R3's
                         "first alias column, even if empty"
    """

    key_combinations: tuple[tuple[str, ...], ...] = DEFAULT_KEY_COMBINATIONS
    aliases: tuple[tuple[str, str], ...] = DEFAULT_ALIASES
    targets: tuple[tuple[str, str], ...] = DEFAULT_TARGETS
    order_by: tuple[str, ...] = ()
    coalesce_aliases: bool = False
    extensions: tuple[str, ...] = field(default=DEFAULT_EXTENSIONS)

    def __post_init__(self):
        object.__setattr__(self, "key_combinations", tuple(tuple(c) for c in self.key_combinations))
        object.__setattr__(self, "aliases", tuple((str(h), str(c)) for h, c in self.aliases))
        object.__setattr__(self, "targets", tuple(_target_pair(t) for t in self.targets))
        object.__setattr__(self, "order_by", tuple(self.order_by))
        object.__setattr__(self, "extensions", tuple(self.extensions))
        if not self.key_combinations:
            raise ValueError("EnrichSpec needs at least one key combination")

    @property
    def target_columns(self) -> list[str]:
        return [c for c, _ in self.targets]

    def with_targets(self, columns: Iterable[str]) -> "EnrichSpec":
        """Keep only the given target columns, in the spec's fixed order."""
        keep = set(columns)
        return replace(self, targets=tuple(t for t in self.targets if t[0] in keep))

    def with_order_by(self, *cols: str) -> "EnrichSpec":
        return replace(self, order_by=tuple(cols))

    @classmethod
    def from_dict(cls, cfg: dict) -> "EnrichSpec":
        """Build from the job's JSON layout: ``column_mapping`` (ordered object),
        ``possible_reference_combinations``, optional ``targets``, ``order_by``,
        ``supported_extensions``."""
        kwargs = {}
        if "column_mapping" in cfg:
            kwargs["aliases"] = tuple(cfg["column_mapping"].items())
        if "possible_reference_combinations" in cfg:
            kwargs["key_combinations"] = tuple(tuple(c) for c in cfg["possible_reference_combinations"])
        if "targets" in cfg:
            kwargs["targets"] = tuple(_target_pair(t) for t in cfg["targets"])
        if "order_by" in cfg:
            kwargs["order_by"] = tuple(cfg["order_by"])
        if "supported_extensions" in cfg:
            kwargs["extensions"] = tuple(cfg["supported_extensions"])
        return cls(**kwargs)

    @classmethod
    def from_json(cls, path: str, spark=None) -> "EnrichSpec":
        """Read the spec once on the driver. With ``spark`` the file may live on
        any Hadoop-compatible file system."""
        if spark is None:
            with open(path, "r", encoding="utf-8") as fh:
                text = fh.read()
        else:
            text = spark.read.text(path, wholetext=True).first()[0]
        return cls.from_dict(json.loads(text))


def _target_pair(t) -> tuple[str, str]:
    if isinstance(t, str):
        return (t, t)
    if isinstance(t, dict):
        return (t["column"], t.get("display", t["column"]))
    col, disp = t
    return (str(col), str(disp))


def spec_for(reference_columns: Sequence[str], order_by: Sequence[str] = (), **kw) -> EnrichSpec:
    """Default spec narrowed to the targets the reference actually has."""
    return EnrichSpec(order_by=tuple(order_by), **kw).with_targets(reference_columns)
