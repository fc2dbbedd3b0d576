"""Text renderers for adjacency and route lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: separator between the nodes of a rendered route.
ROUTE_SEPARATOR = " -> "


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def adjacency_line(node, neighbors) -> Column:
    """``"node n1 n2 ..."``; a node without neighbours renders as ``"node "``."""
    return F.concat(_c(node).cast("string"), F.lit(" "),
                    F.concat_ws(" ", _c(neighbors).cast("array<string>")))


def route_line(src, dst, path) -> Column:
    """``"src -> a -> b -> dst"``.

    The interior is the path with every occurrence of ``src`` and ``dst``
    removed; the ends are always the query's own endpoints.
    """
    src, dst, path = _c(src), _c(dst), _c(path)
    interior = F.filter(path, lambda x: (x != src) & (x != dst))
    nodes = F.concat(F.array(src), interior, F.array(dst))
    return F.array_join(nodes.cast("array<string>"), ROUTE_SEPARATOR)
