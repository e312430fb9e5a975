"""Scene catalogues by pages: the address of a search, its pages within limits, and a stored copy by fingerprint."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass
from hashlib import sha256
from urllib.parse import urlencode

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from .readers import scene_items

#: Items of a search, at most.
MAXIMUM_ITEMS = 5000


class TooManyItems(ValueError):
    """A search gave more items than a catalogue may hold."""


@dataclass(frozen=True)
class SceneSearch:
    """What is searched: a collection within a box (degrees) and days, and the rules that the items are held against."""

    endpoint: str
    collection: str
    box: tuple[float, float, float, float]
    first_day: str
    last_day: str
    months: tuple[int, ...] = ()
    maximum_cloud: float = 100.0
    assets: tuple[str, ...] = ()
    page_size: int = 100

    @property
    def url(self) -> str:
        asked = {"collections": self.collection, "bbox": ",".join(f"{v:.8f}" for v in self.box), "datetime": f"{self.first_day}T00:00:00Z/{self.last_day}T23:59:59Z", "limit": self.page_size}
        return f"{self.endpoint.rstrip('/')}/search?{urlencode(asked)}"

    @property
    def fingerprint(self) -> str:
        """Differs if the address or a rule does."""
        return sha256(json.dumps({"url": self.url} | asdict(self), sort_keys=True).encode()).hexdigest()


def pages(url: str, getter: Callable[[str], Mapping], maximum: int = MAXIMUM_ITEMS) -> list[Mapping]:
    """The pages from an address on, along their links named next, each address once; an error beyond the maximum of items."""
    found, seen, items = [], set(), 0
    while url and url not in seen:
        seen.add(url)
        page = getter(url)
        if not isinstance(page.get("features", []), list):
            raise ValueError(f"features of {url} are no list")
        found.append(page)
        items += len(page.get("features", []))
        if items > maximum:
            raise TooManyItems(f"more than {maximum} items")
        url = next((x.get("href") for x in page.get("links", []) if x.get("rel") == "next"), None)
    return found


def scene_catalogue(spark: SparkSession, search: SceneSearch, getter: Callable[[str], Mapping], store: str, refresh: bool = False) -> DataFrame:
    """The scenes of a search, as scene_items gives them, from the store if it holds this search.

    The driver follows the pages, whose items are at most MAXIMUM_ITEMS.
    """
    folder = f"{store}/{search.fingerprint}"
    try:
        there = not refresh and not spark.read.text(folder).isEmpty()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        there = False
    if not there:
        texts: Sequence[tuple[str]] = [(json.dumps({"features": p.get("features", [])}),) for p in pages(search.url, getter)]
        spark.createDataFrame(texts, "value string").coalesce(1).write.mode("overwrite").text(folder)
    return scene_items(spark, folder, line_each=True)
