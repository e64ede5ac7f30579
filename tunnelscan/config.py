"""Scoring thresholds and answer-exclusion lists (O-07)."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

# The reference configuration file, kept verbatim (including the
# "eNSEC" spelling) so that results match it.
DEFAULT_EXCLUDED_RTYPES = ("RRSIG", "DNSKEY", "DS", "eNSEC", "NSEC3", "CDNSKEY", "CDS", "TSIG", "TKEY")
DEFAULT_EXCLUDED_RDATA = ("v=spf1", "docusign=", "verification=")
DEFAULT_MIN_GROUP_COUNT = 100
DEFAULT_MIN_UNIQUE_QNAME_SHARE = 0.33
DEFAULT_MIN_TUNNEL_SHARE = 0.33

# Keys of the config file.
_JSON_KEYS = {
    "EXCLUDED_RTYPE_LIST": "excluded_rtypes",
    "EXCLUDED_RDATA_LIST": "excluded_rdata",
    "MIN_IP_IP_2LD_COUNT": "min_group_count",
    "MIN_IP_IP_2LD_UNIQUE_QNAME_PERC": "min_unique_qname_share",
    "MIN_IP_IP_2LD_TUNNEL_PERC": "min_tunnel_share",
}


@dataclass(frozen=True)
class ScoringConfig:
    """Thresholds of the per (source, destination, domain) verdict.

    All three comparisons are inclusive (``>=``).
    """

    excluded_rtypes: tuple[str, ...] = DEFAULT_EXCLUDED_RTYPES
    excluded_rdata: tuple[str, ...] = DEFAULT_EXCLUDED_RDATA
    min_group_count: int = DEFAULT_MIN_GROUP_COUNT
    min_unique_qname_share: float = DEFAULT_MIN_UNIQUE_QNAME_SHARE
    min_tunnel_share: float = DEFAULT_MIN_TUNNEL_SHARE
    extra: dict = field(default_factory=dict, compare=False)

    @classmethod
    def from_dict(cls, cfg: dict) -> "ScoringConfig":
        missing = [k for k in _JSON_KEYS if k not in cfg]
        if missing:
            raise KeyError(f"config is missing {missing}")
        kwargs = {attr: cfg[key] for key, attr in _JSON_KEYS.items()}
        kwargs["excluded_rtypes"] = tuple(kwargs["excluded_rtypes"])
        kwargs["excluded_rdata"] = tuple(kwargs["excluded_rdata"])
        kwargs["min_group_count"] = int(kwargs["min_group_count"])
        kwargs["min_unique_qname_share"] = float(kwargs["min_unique_qname_share"])
        kwargs["min_tunnel_share"] = float(kwargs["min_tunnel_share"])
        extra = {k: v for k, v in cfg.items() if k not in _JSON_KEYS}
        return cls(extra=extra, **kwargs)

    @classmethod
    def from_json(cls, path: str) -> "ScoringConfig":
        with open(path, "r", encoding="utf-8") as fp:
            return cls.from_dict(json.load(fp))

    def to_dict(self) -> dict:
        return {key: (list(getattr(self, attr)) if isinstance(getattr(self, attr), tuple)
                      else getattr(self, attr)) for key, attr in _JSON_KEYS.items()}

    def with_(self, **changes) -> "ScoringConfig":
        return replace(self, **changes)
