"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from .decontaminate import op3_decontaminate
from .licenses import ORACLE as LICENSES_SQL
from .licenses import op10_licenses
from .neardup import op6_near_duplicates
from .packing import op7_packing
from .quality import op4_quality
from .secrets import ORACLE as SECRETS_SQL
from .secrets import op5_secrets
from .sstable import op9_sstable
from .suffix import op8_suffix_dedup
from .toxicity import op1_toxicity
from .urlfilter import ORACLE as URLS_SQL
from .urlfilter import op2_urls

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_urls": op2_urls,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality": op4_quality,
    "op5_secrets": op5_secrets,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_packing": op7_packing,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_sstable": op9_sstable,
    "op10_licenses": op10_licenses,
}
ORACLES: dict[str, str] = {
    "op2_urls": URLS_SQL,
    "op5_secrets": SECRETS_SQL,
    "op10_licenses": LICENSES_SQL,
}
