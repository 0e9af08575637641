"""Driver-side orchestration: settings, stage order, and stages composed of DataFrame steps."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions import cols
from folioforge.operators import relational as rel

#: Stages and download sources in their order.
STAGES = ["gather", "download", "extract", "create_analyses", "upload", "sync"]
SOURCES = ["pubget", "elsevier", "ace"]
SUPPORTS = {"pubget": ("pmcid",), "elsevier": ("pmid", "doi"), "ace": ("pmid",)}


@dataclass(frozen=True)
class Settings:
    data_root: str = "data"
    stages: tuple[str, ...] = ()
    sources: tuple[str, ...] = tuple(SOURCES)
    use_cached_inputs: bool = True
    ignore_cache: tuple[str, ...] = ()
    export_overwrite: bool = True
    upload_mode: str = "FILL"
    dry_run: bool = False

    def merged(self, *layers: dict) -> Settings:
        """Later layers win; unknown names raise."""
        out = self
        known = {f.name for f in fields(self)}
        for layer in layers:
            if unknown := set(layer) - known:
                raise ValueError(f"unknown settings: {sorted(unknown)}")
            out = replace(out, **{k: v for k, v in layer.items() if v is not None})
        return out


def _typed(values: dict[str, str]) -> dict:
    """Texts as the settings' types: true and false, lists by commas."""
    kinds = {f.name: f.default for f in fields(Settings)}
    out: dict = {}
    for name, text in values.items():
        if name not in kinds:
            raise ValueError(f"unknown setting: {name}")
        text = text.strip()
        if isinstance(kinds[name], bool):
            out[name] = text.lower() in ("1", "true", "yes", "on")
        elif isinstance(kinds[name], tuple):
            out[name] = tuple(v.strip() for v in text.strip("[]").split(",") if v.strip())
        else:
            out[name] = text
    return out


def from_environment(environ) -> dict:
    return _typed({k.removeprefix("FOLIOFORGE_").lower(): v for k, v in environ.items() if k.startswith("FOLIOFORGE_")})


def from_file(path: str) -> dict:
    """Lines `name: value`; blank lines and lines that start with # are skipped."""
    with open(path, encoding="utf-8") as file:
        lines = [line for line in map(str.strip, file) if line and not line.startswith("#")]
    return _typed(dict(line.split(":", 1) for line in lines))


def normalize_stages(stages) -> list[str]:
    """Lower-cased, checked, distinct, in canonical order; none means all."""
    wanted = [s.strip().lower() for s in stages or []]
    if bad := [s for s in wanted if s not in STAGES]:
        raise ValueError(f"unknown stages: {bad}")
    return [s for s in STAGES if s in wanted] if wanted else list(STAGES)


@dataclass
class State:
    frames: dict[str, DataFrame] = field(default_factory=dict)
    done: list[str] = field(default_factory=list)


def run_stages(settings: Settings, handlers: dict[str, Callable[[Settings, State], DataFrame | None]]) -> State:
    state = State()
    for stage in normalize_stages(settings.stages):
        if not settings.dry_run and stage in handlers:
            out = handlers[stage](settings, state)
            if out is not None:
                state.frames[stage] = out
        state.done.append(stage)
    return state


def normalize(df: DataFrame) -> DataFrame:
    out = df.withColumns({"pmid": cols.normalize_pmid(F.col("pmid")), "doi": cols.normalize_doi(F.col("doi")), "pmcid": cols.normalize_pmcid(F.col("pmcid"))})
    if "other_ids" in df.columns:
        out = out.withColumn("other_ids", cols.normalize_other_ids(F.col("other_ids")))
    return out.withColumn("slug", cols.identifier_slug(F.col("pmid"), F.col("doi"), F.col("pmcid")))


def gather(manifest: DataFrame, found: DataFrame, providers: list[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Manifest, then search results, normalised; the first row a slug stays, before and after the providers."""
    rows = normalize(manifest.withColumn("part", F.lit(0)).unionByName(found.withColumn("part", F.lit(1)), allowMissingColumns=True))
    rows = rows.withColumn("pos", F.struct("part", "pos")).drop("part")
    rows = rel.keep_first(rows, ["slug"])
    for provider in providers:
        rows = normalize(provider(rows))
    return rel.keep_first(rows, ["slug"])


def download(requests: DataFrame, fetchers: dict[str, Callable[[DataFrame], DataFrame]], sources: tuple[str, ...] = tuple(SOURCES)) -> tuple[list[DataFrame], DataFrame]:
    any_of = lambda names: F.coalesce(*(cols.missing(F.col(n)) for n in names)).isNotNull()
    return rel.source_cascade(requests, [(s, any_of(SUPPORTS[s]), fetchers[s]) for s in sources])


def metadata_merge(rows: DataFrame, order: dict[str, int]) -> DataFrame:
    prio = F.element_at(F.create_map(*(F.lit(x) for kv in order.items() for x in kv)), F.col("source"))
    return rel.metadata_fold(rows.withColumn("prio", prio), "slug", "prio")
