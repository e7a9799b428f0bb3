"""Parameters of a run, with their defaults and checks."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

#: Where a run may begin; any other value means the whole run.
STAGES = ("full", "antirepeat", "fill", "clean")


@dataclass(frozen=True)
class Params:
    reference_chunk: int = 175_000_000
    query_chunk: int = 50_000_000
    reference_overlap: int = 0
    query_overlap: int = 10_000
    lastz_y: int = 9400
    lastz_h: int = 2000
    lastz_l: int = 3000
    lastz_k: int = 2400
    seed_length: int = 12
    #: Words with more places on the target don't seed, as with any aligner's repeat limit; None keeps all.
    seed_limit: int | None = 200
    min_chain_score: int = 1000
    linear_gap: str = "loose"
    bundle_max_bases: int = 1_000_000
    max_chain_gap: int = 100_000
    skip_fill: bool = False
    skip_unmask: bool = False
    skip_clean: bool = False
    fill_files: int = 1000
    fill_score: int = 5000
    fill_k: int = 2000
    fill_gap_min: int = 30
    fill_gap_max: int = 20_000
    clean_fold: float = 2.5
    clean_fold_pairs: float = 10.0
    clean_pair_distance: int = 10_000
    clean_max_suspect: int = 100_000
    clean_min_broken: int = 75_000
    antirepeat_min_score: int = 5_000
    #: A file of substitution scores and gap costs of the alignment; None: the defaults.
    score_scheme: str | None = None
    start: str = "full"

    def errors(self) -> list[str]:
        """All that is wrong, not only the first."""
        out = []
        for side in ("reference", "query"):
            chunk, overlap = getattr(self, f"{side}_chunk"), getattr(self, f"{side}_overlap")
            if chunk < 1:
                out.append(f"{side}_chunk has to be at least 1")
            if not 0 <= overlap < max(chunk, 1):
                out.append(f"{side}_overlap has to be at least 0 and less than {side}_chunk")
        if self.linear_gap not in ("loose", "medium"):
            out.append("linear_gap has to be loose or medium")
        if self.fill_gap_min > self.fill_gap_max:
            out.append("fill_gap_min is over fill_gap_max")
        for name in ("min_chain_score", "bundle_max_bases", "fill_files", "seed_length"):
            if getattr(self, name) < 0 or name != "min_chain_score" and not getattr(self, name):
                out.append(f"{name} is too small")
        return out

    def validate(self) -> Params:
        if found := self.errors():
            raise ValueError("; ".join(found))
        return self

    def begin(self) -> str:
        return self.start if self.start in STAGES else "full"

    def inner_threshold(self) -> int:
        """0, like a missing value, means the default."""
        return self.lastz_h or 2000


def from_mapping(values: Mapping[str, object]) -> Params:
    """Known keys of a map; null keeps a default, an unknown key is an error."""
    known = {f.name for f in fields(Params)}
    unknown = sorted(set(values) - known)
    if unknown:
        raise ValueError(f"unknown parameters: {', '.join(unknown)}")
    return replace(Params(), **{k: v for k, v in values.items() if v is not None}).validate()


def read_params(path: str) -> Params:
    """From a JSON object; a comma before a closing brace is forgiven."""
    with open(path, encoding="utf-8") as f:
        got = json.loads(re.sub(r",(\s*[}\]])", r"\1", f.read()))
    if not isinstance(got, dict):
        raise ValueError("parameters have to be a JSON object")
    return from_mapping(got)
