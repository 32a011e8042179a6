"""Settings of a run, and their checks."""
from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions.coords import lengths

METHODS = ("RIBO", "TIS", "TTS", "RNA", "RNATIS", "RNATTS")
FILTERS = ("overlap", "length", "rpkm")
STYLES = ("fiveprime", "threeprime", "centered", "global")
NORMS = ("raw", "cpm", "window")
WORKFLOWS = ("full", "preprocessing", "trimming")


@dataclass
class Settings:
    differential_expression: bool = False
    features: list[str] = field(default_factory=lambda: ["CDS", "sRNA"])
    contrasts: list[str] = field(default_factory=list)
    padj_cutoff: float = 0.05
    log2fc_cutoff: float = 1.0
    read_lengths: str = "10-80"
    positions_outside: int = 100
    positions_inside: int = 150
    filtering: list[str] = field(default_factory=lambda: list(FILTERS))
    neighbour_distance: int = 50
    rpkm_threshold: float = 10.0
    length_cutoff: int = 50
    mapping_styles: list[str] = field(default_factory=lambda: ["fiveprime", "threeprime"])
    metagene_lengths: str = "25-34"
    normalisation: list[str] = field(default_factory=lambda: list(NORMS))
    workflow: str = "full"

    def problems(self, conditions: list[str]) -> list[str]:
        """What is wrong with the settings, given the sample sheet's conditions; empty if nothing is."""
        out = []
        for name, given, known in (("filtering", self.filtering, FILTERS), ("mapping_styles", self.mapping_styles, STYLES), ("normalisation", self.normalisation, NORMS), ("workflow", [self.workflow], WORKFLOWS)):
            out += [f"{name}: unknown {x}" for x in given if x not in known]
        for name, value, low, high in (("padj_cutoff", self.padj_cutoff, 0, 1), ("log2fc_cutoff", self.log2fc_cutoff, 0, float("inf")), ("positions_outside", self.positions_outside, 0, float("inf")), ("positions_inside", self.positions_inside, 1, float("inf")), ("neighbour_distance", self.neighbour_distance, 0, float("inf")), ("rpkm_threshold", self.rpkm_threshold, 0, float("inf")), ("length_cutoff", self.length_cutoff, 0, float("inf"))):
            if not low <= value <= high:
                out.append(f"{name}: {value} isn't within {low} and {high}")
        for name, spec in (("read_lengths", self.read_lengths), ("metagene_lengths", self.metagene_lengths)):
            try:
                lengths(spec)
            except ValueError as e:
                out.append(f"{name}: {e}")
        known = {c.lower() for c in conditions}
        for c in self.contrasts:
            parts = c.split("-")
            if len(parts) != 2 or {p.lower() for p in parts} - known:
                out.append(f"contrasts: {c} isn't a pair of conditions")
        if self.differential_expression and len(known) < 2:
            out.append("differential_expression needs two conditions")
        if self.differential_expression and not self.features:
            out.append("features: none given")
        return out


def _within(low: float, high: float = float("inf"), inside: bool = False) -> tuple[str, Callable]:
    return f"isn't {'between' if inside else 'within'} {low} and {high}", (lambda v: low < v < high) if inside else (lambda v: low <= v <= high)


def _one_of(*known: str) -> tuple[str, Callable]:
    return f"isn't one of {', '.join(known)}", lambda v: v.lower() in known


_SWITCH = (str, *_one_of("on", "off"))
_FILE = ("file", "isn't a file", None)
_LENGTHS = (str, "isn't a list of lengths", lambda v: bool(v) and bool(lengths(v)))
#: Sections and keys of a settings file. A key has its kind, what is wrong otherwise, and what its value, or each value of a list, must fulfil.
KEYS: dict[str, dict[str, tuple]] = {
    "biologySettings": {**{k: (str, "", None) for k in ("adapterS3", "adapterS5", "adapterP3R1", "adapterP5R1", "adapterP3R2", "adapterP5R2")}, "genome": _FILE, "annotation": _FILE, "samples": _FILE, "alternativeStartCodons": (list, "isn't a codon", lambda v: bool(re.fullmatch("[ACGT]{3}", v)))},
    "differentialExpressionSettings": {"differentialExpression": _SWITCH, "features": (list, "", None), "contrasts": (list, "isn't a pair of conditions", lambda v: v.count("-") == 1), "padjCutoff": (float, *_within(0, 1, inside=True)), "log2fcCutoff": (float, *_within(0))},
    "predictionSettings": {"deepribo": _SWITCH},
    "readstatSettings": {"readLengths": _LENGTHS},
    "metageneSettings": {
        "positionsOutsideORF": (int, *_within(0)), "positionsInORF": (int, *_within(0)), "filteringMethods": (list, *_one_of(*FILTERS)), "neighboringGenesDistance": (int, *_within(0)), "rpkmThreshold": (float, *_within(0)), "lengthCutoff": (int, *_within(0)),
        "mappingMethods": (list, *_one_of(*STYLES)), "readLengths": _LENGTHS, "normalizationMethods": (list, *_one_of(*NORMS)), "outputFormats": (list, *_one_of("interactive", "svg", "png", "pdf", "jpg")), "includePlotlyJS": (str, *_one_of("integrated", "online", "local")), "colorList": (list, "", None),
    },
    "workflowSettings": {"workflow": (str, *_one_of(*WORKFLOWS))},
}
#: Where a key's value goes in Settings.
FIELDS = {
    "differentialExpression": "differential_expression", "features": "features", "contrasts": "contrasts", "padjCutoff": "padj_cutoff", "log2fcCutoff": "log2fc_cutoff", "readstatSettings.readLengths": "read_lengths", "positionsOutsideORF": "positions_outside", "positionsInORF": "positions_inside",
    "filteringMethods": "filtering", "neighboringGenesDistance": "neighbour_distance", "rpkmThreshold": "rpkm_threshold", "lengthCutoff": "length_cutoff", "mappingMethods": "mapping_styles", "metageneSettings.readLengths": "metagene_lengths", "normalizationMethods": "normalisation", "workflow": "workflow",
}


def file_problems(settings: dict, conditions: list[str] | None = None, exists: Callable[[str], bool] | None = None) -> list[str]:
    """What is wrong with a settings file's contents: missing sections and keys, kinds, values, files that exists() denies, contrasts of other conditions."""
    out = []
    for section, keys in KEYS.items():
        held = settings.get(section)
        if not isinstance(held, dict):
            out.append(f"{section}: missing")
            continue
        for key, (kind, text, good) in keys.items():
            name = f"{section}.{key}"
            if key not in held:
                out.append(f"{name}: missing")
                continue
            value = held[key]
            if not isinstance(value, str if kind == "file" else kind) or isinstance(value, bool):
                out.append(f"{name}: {value!r} isn't of type {'str' if kind == 'file' else kind.__name__}")
                continue
            if kind == "file":
                out += [f"{name}: {value} {text}"] if exists and not exists(value) else []
            for one in value if kind is list else [value]:
                if kind is list and not isinstance(one, str):
                    out.append(f"{name}: {one!r} isn't of type str")
                    continue
                try:
                    fine = good is None or kind == "file" or good(one)
                except ValueError:
                    fine = False
                if not fine:
                    out.append(f"{name}: {one} {text}")
    de = settings.get("differentialExpressionSettings")
    if isinstance(de, dict):
        if de.get("features") == []:
            out.append("differentialExpressionSettings.features: none given")
        if conditions is not None and isinstance(de.get("contrasts"), list):
            known = set(conditions)
            out += [f"differentialExpressionSettings.contrasts: {c} has an unknown condition" for c in de["contrasts"] if isinstance(c, str) and c.count("-") == 1 and set(c.split("-")) - known]
    return out


def loaded(settings: dict) -> Settings:
    """Settings of a settings file's contents; what it lacks keeps its default."""
    out = Settings()
    for section, held in settings.items():
        for key, value in held.items() if isinstance(held, dict) else ():
            name = FIELDS.get(f"{section}.{key}") or (FIELDS.get(key) if section in KEYS and key in KEYS[section] else None)
            if name:
                value = value.lower() == "on" if name == "differential_expression" and isinstance(value, str) else value
                setattr(out, name, [v.lower() for v in value] if name in ("filtering", "mapping_styles", "normalisation") else value)
    return out


def read_file(path: str) -> dict:
    """The contents of a YAML settings file."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def sample_problems(samples: DataFrame) -> DataFrame:
    """method, condition, replicate, problem of each bad row of the sample sheet."""
    checks = [
        (F.col("method").isNull() | ~F.col("method").isin(*METHODS), "unknown method"), (F.col("condition").isNull() | ~F.col("condition").rlike("^[A-Za-z0-9]+$"), "condition isn't of letters and digits"),
        (F.col("replicate").isNull() | ~F.col("replicate").rlike("^[1-9][0-9]*$"), "replicate isn't a whole number from 1"), (F.col("fastqFile").isNull() | (F.trim("fastqFile") == ""), "no file"),
    ]
    found = F.filter(F.array(*[F.when(bad, F.lit(text)) for bad, text in checks]), lambda x: x.isNotNull())
    bad = samples.select("method", "condition", "replicate", F.explode(found).alias("problem"))
    again = samples.groupBy("method", "condition", "replicate").count().where("count > 1").select("method", "condition", "replicate", F.lit("sample is there twice").alias("problem"))
    return bad.union(again)
