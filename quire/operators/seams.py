"""Models behind plain functions: layout, text, formula and caption engines, and the plan that runs them.

An engine is loaded once a worker by a factory and gets batches. A wrong name or a missing engine is an
error; a failing figure is a warning in its row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry, text
from . import layout, runs, segments


class EngineError(RuntimeError):
    """An engine failed; nothing else is tried in its place."""


#: (image bytes) -> rows of (label, x1, y1, x2, y2, confidence); and (crop bytes) -> text.
LayoutEngine = Callable[[bytes], list[tuple[str, float, float, float, float, float]]]
TextEngine = Callable[[bytes], str]

ENGINES = {"layout": ["surya", "mineru", "doclayout"], "text": ["vlm", "ppocr"], "formula": ["vlm", "got", "unimernet"]}


@dataclass(frozen=True)
class Settings:
    """What a run needs to know. Decoding is always greedy; stop ids of the model's own file come first."""

    layout: str = "mineru"
    text: str = "vlm"
    formula: str = "vlm"
    skip_figures: bool = True
    panel_threshold: float = 0.75
    panels: bool = False
    page_limit: int = 0
    max_new_tokens: int = 1024
    near_limit: float = 0.9
    stop_ids: tuple[int, ...] = field(default=())

    def __post_init__(self) -> None:
        for kind, names in ENGINES.items():
            if getattr(self, kind) not in names:
                raise EngineError(f"unknown {kind} engine: {getattr(self, kind)}")

    @staticmethod
    def of(config: dict) -> Settings:
        """Settings of a configuration's nested keys; the rest as it is."""
        flat = {k: v for section in config.values() if isinstance(section, dict) for k, v in section.items()} | {k: v for k, v in config.items() if not isinstance(v, dict)}
        return Settings(**{k: v for k, v in flat.items() if k in Settings.__dataclass_fields__})


def pick_stop_ids(generation: list[int] | int | None, tokenizer: list[int] | int | None) -> list[int]:
    """Stop ids of the generation file if it has any, else the tokenizer's."""
    for ids in (generation, tokenizer):
        if ids not in (None, []):
            return list(ids) if isinstance(ids, (list, tuple)) else [ids]
    return []


def near_limit(n_tokens: int, limit: int, share: float = 0.9) -> bool:
    """Whether a reply is so long that it may have been cut."""
    return limit > 0 and n_tokens >= share * limit


def flatten_lines(result: object) -> list[str]:
    """Lines of a recognizer's result: dictionaries with rec_texts, (text, score) pairs, and lists of these."""
    if result is None:
        return []
    if isinstance(result, str):
        return [result]
    if isinstance(result, dict):
        return [str(t) for t in result.get("rec_texts", [])]
    if isinstance(result, tuple) and len(result) == 2 and isinstance(result[0], str):
        return [result[0]]
    return [line for x in result for line in flatten_lines(x)] if isinstance(result, (list, tuple)) else []


def scan(pages: DataFrame, factory: Callable[[], LayoutEngine], keys: list[str]) -> DataFrame:
    """(keys, index, label, bbox, confidence, position, error): what an engine finds on page images (keys, content).
    An engine may give a predicted position behind the confidence. A page that fails is one row with its error and no label,
    so that the other pages go on."""
    shape = pages.select(*keys).schema.simpleString()[7:-1] + ",index int,label string,bbox array<double>,confidence double,position int,error string"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = factory()
        for df in parts:
            rows = []
            for *key, data in df.itertuples(index=False):
                try:
                    found = [(label, list(rest[:4]), rest[4], rest[5] if len(rest) > 5 else None) for label, *rest in engine(data)]
                    rows += [(*key, i, *f, None) for i, f in enumerate(found)]
                except Exception as e:
                    rows.append((*key, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            out = pd.DataFrame(rows, columns=[*keys, "index", "label", "bbox", "confidence", "position", "error"])
            yield out.astype({"index": "Int32", "position": "Int32"})

    return pages.select(*keys, "content").mapInPandas(run, shape)


def blocks_of(found: DataFrame, detector: str, keys: list[str]) -> DataFrame:
    """What ``scan`` found as blocks in reading order; failed pages have none."""
    kept = layout.detections(found.where("error is null").drop("error"), detector, keys)
    boxes = [F.col("bbox")[i].alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))]
    return layout.reading_order(kept.select("*", *boxes), keys)


def detect(pages: DataFrame, factory: Callable[[], LayoutEngine], detector: str, keys: list[str]) -> DataFrame:
    """Blocks of page images (keys, content) in reading order; ``scan`` tells which pages failed."""
    return blocks_of(scan(pages, factory, keys), detector, keys)


def crops(blocks: DataFrame, pages: DataFrame, keys: list[str], cut: Callable[[bytes, tuple[int, int, int, int]], bytes], pad: int = 2) -> DataFrame:
    """Blocks with ``crop``, the part of their page's image that they cover, with a margin, cut by a function that callers give.
    pages: (keys, content, width, height)."""
    sized = blocks.join(pages.select(*keys, "content", F.col("width").alias("_w"), F.col("height").alias("_h")), keys)
    sized = sized.withColumn("_box", geometry.crop_box(geometry.box(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]), F.col("_w"), F.col("_h"), pad))

    @F.pandas_udf("binary")
    def run(data: pd.Series, box: pd.DataFrame) -> pd.Series:
        return pd.Series([cut(bytes(d), tuple(b)) for d, b in zip(data, box[["x1", "y1", "x2", "y2"]].itertuples(index=False), strict=True)], dtype=object)

    return sized.withColumn("crop", run("content", "_box")).drop("content", "_w", "_h", "_box")


def panel_pages(pages: DataFrame, cut: Callable[[bytes, tuple[int, int, int, int]], bytes], settings: Settings) -> DataFrame:
    """Pages (…, content, width, height, pixels) as panels, each with its version, its box in shares of the page (panel) and
    its own image; a page that isn't split is one panel, v0."""
    told = layout.decide_panels(pages, settings.panel_threshold, settings.panels)
    one = F.array(F.struct(F.lit("v0").alias("version_id"), geometry.box(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0)).alias("box")))
    each = told.withColumn("_p", F.explode(F.when(F.size("panels") > 0, F.col("panels")).otherwise(one))).withColumn("_split", F.size("panels") > 0)
    each = each.withColumn("_px", geometry.to_pixels(F.col("_p.box"), F.col("width"), F.col("height")))

    @F.pandas_udf("binary")
    def run(data: pd.Series, box: pd.DataFrame, split: pd.Series) -> pd.Series:
        return pd.Series([cut(bytes(d), tuple(b)) if s else bytes(d) for d, b, s in zip(data, box[["x1", "y1", "x2", "y2"]].itertuples(index=False), split, strict=True)], dtype=object)

    out = each.withColumn("content", run("content", "_px", "_split")).withColumn("page_width", F.col("width").cast("double")).withColumn("page_height", F.col("height").cast("double"))
    return out.select(*[c for c in pages.columns if c not in ("pixels", "width", "height")], F.col("_p.version_id").alias("version_id"), F.col("_p.box").alias("panel"), "page_width", "page_height")


def detect_panels(panels: DataFrame, factory: Callable[[], LayoutEngine], detector: str, keys: list[str]) -> DataFrame:
    """Blocks of panels as blocks of their pages: each panel is analysed on its own, its boxes are moved to the page and
    panels follow one another. panels: from ``panel_pages``."""
    own = [*keys, "version_id"]
    found = detect(panels, factory, detector, own).join(panels.select(*own, "panel", "page_width", "page_height"), own)
    found = found.withColumn("bbox", geometry.box(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]))
    moved = layout.merge_panels(found, keys, last=["index"])
    return moved.select(*[c for c in moved.columns if c not in ("x1", "y1", "x2", "y2", "panel", "page_width", "page_height")], "bbox.x1", "bbox.y1", "bbox.x2", "bbox.y2")


def read_blocks(blocks: DataFrame, engines: dict[str, Callable[[], TextEngine]], crop: str = "crop", isolate: bool = False) -> DataFrame:
    """Routed blocks with raw_text from the engine of their route, empty for those skipped. Of each batch the blocks of one
    engine are read before those of the next, in the order of ``engines``, so that one engine is at work at a time.
    isolate: a failing block, or one without text, has its error in ``error`` and the others go on."""
    named = [f"`{c}` {t}" for c, t in blocks.dtypes if c not in ("raw_text", "error")] + ["raw_text string"] + ["error string"] * isolate

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready: dict[str, TextEngine] = {}
        for df in parts:
            todo = df.index[~df["skipped"].astype(bool)]
            missing = set(df.loc[todo, "route"]) - set(engines)
            if missing:
                raise EngineError(f"no engine for {', '.join(sorted(map(str, missing)))}")
            said, error = pd.Series("", df.index, dtype=object), pd.Series(None, df.index, dtype=object)
            for to in engines:
                mine = todo[df.loc[todo, "route"] == to]
                if len(mine) and to not in ready:
                    ready[to] = engines[to]()
                for i in mine:
                    try:
                        said[i] = ready[to](df.at[i, crop])
                        error[i] = None if said[i].strip() else "empty text"
                    except Exception as e:
                        if not isolate:
                            raise
                        error[i] = f"{type(e).__name__}: {e}"
            out = df.drop(columns=[c for c in ("raw_text", "error") if c in df]).assign(raw_text=said)
            yield out.assign(error=error) if isolate else out

    return blocks.drop("raw_text", *["error"] * isolate).mapInPandas(run, ", ".join(named))


def page_texts(pages: DataFrame, factory: Callable[[], TextEngine], keys: list[str]) -> DataFrame:
    """(keys, text, error): whole pages (keys, content) through one engine, its replies cleaned. A page that fails, or has no
    text, keeps the reason in its row; the others go on."""
    shape = pages.select(*keys).schema.simpleString()[7:-1] + ",reply string,failed string"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = factory()
        for df in parts:
            rows = []
            for *key, data in df.itertuples(index=False):
                try:
                    rows.append((*key, engine(data), None))
                except Exception as e:
                    rows.append((*key, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=[*keys, "reply", "failed"])

    read = pages.select(*keys, "content").mapInPandas(run, shape).withColumn("text", text.truthy(text.clean_reply("reply")))
    return read.select(*keys, "text", F.coalesce("failed", F.when(F.col("text").isNull(), "empty text")).alias("error"))


def with_prompt(model: Callable[[str], str], prompt: str) -> Callable[[str], str]:
    """A model that gets a prompt before each text."""
    return lambda piece: model(prompt + piece)


def backend(config: dict) -> str:
    """Which client a configuration asks for: the vlm section's backend, or glm without such a section."""
    return (config["vlm"] or {}).get("backend", "qwen") if "vlm" in config else "glm"


def greedy(options: dict) -> dict:
    """Options of a generation that never samples."""
    return {k: v for k, v in options.items() if k not in ("temperature", "top_p", "top_k")} | {"do_sample": False}


def caption_figures(figures: DataFrame, factory: Callable[[], TextEngine], crop: str = "crop") -> DataFrame:
    """Figures with caption and error: a failure, or an empty caption, is the row's error."""
    named = [f"`{c}` {t}" for c, t in figures.dtypes]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = factory()
        for df in parts:
            said = []
            for data in df[crop]:
                try:
                    text = engine(data).strip()
                    said.append((text or None, None if text else "empty caption"))
                except Exception as e:  # one figure's failure isn't the page's
                    said.append((None, str(e)))
            yield df.assign(caption=[s for s, _ in said], error=[e for _, e in said])

    return figures.mapInPandas(run, ", ".join([*named, "caption string", "error string"]))


def drafts_of(pages: DataFrame, keys: list[str], find: Callable[[], LayoutEngine], engines: dict[str, Callable[[], TextEngine]], settings: Settings, cut: Callable[[bytes, tuple[int, int, int, int]], bytes] | None = None) -> DataFrame:
    """(keys, draft): from page images to drafts. With ``cut``, which needs pages with width and height, and with pixels for
    panels, engines get each block's part of the page, else the whole page."""
    if settings.page_limit:
        pages = layout_limit(pages, settings.page_limit, keys)
    if cut is not None and settings.panels:
        found = detect_panels(panel_pages(pages, cut, settings), find, settings.layout, keys)
    else:
        found = detect(pages, find, settings.layout, keys).withColumn("version_id", F.lit("v0" if settings.panels else None).cast("string"))
    blocks = layout.route(found)
    if not settings.skip_figures:
        blocks = blocks.withColumn("skipped", F.col("route") == "none").withColumn("skip_reason", F.lit(None).cast("string"))
    blocks = crops(blocks, pages, keys, cut) if cut is not None else blocks.join(pages.select(*keys, F.col("content").alias("crop")), keys)
    return segments.stitch(read_blocks(blocks, engines), keys)


def layout_limit(pages: DataFrame, most: int, keys: list[str] | None = None) -> DataFrame:
    """Each document's first pages in their order, whatever their numbers; 0: all."""
    return runs.page_limit(pages, [k for k in keys or [] if k != "page"], most, "page")
