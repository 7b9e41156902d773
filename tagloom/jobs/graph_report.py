"""Build labelled co-occurrence graphs from vertex/edge files, merge them
and write the analysis files.

    python -m tagloom.jobs.graph_report --out OUT \
        --graph V1 E1 --graph V2 E2 --graph V3 E3 --threshold 15 \
        [--second V E --second ... --second-threshold 8] [--reverse] [--rejects DIR]

Writes under OUT: ``graph.gexf/`` (merged graph), ``components.txt/`` (one
line per connected component), ``low_degree.gexf/`` (edges touching a
vertex of degree 1-2, all vertices) and, with ``--second``,
``second_graph.gexf/`` (the second merged graph). Each output is a
folder of ordered part files. A line that cannot be parsed fails the job,
or goes to a folder of its graph under DIR.
"""

from __future__ import annotations

import argparse
import os

from tagloom.operators.components import connected_components
from tagloom.operators.graph import Graph, low_degree_subgraph, merge_many
from tagloom.session import checkpoint, get_session
from tagloom.sinks.gexf import write_gexf
from tagloom.sinks.text import write_components
from tagloom.sources.lines import graph_from_files


def merged(spark, files: list, threshold: int, reverse: bool, raw_line: bool, rejects: str | None = None) -> Graph:
    graphs = [graph_from_files(spark, v, e, threshold, raw_line, rejects and os.path.join(rejects, f"graph{i}"))
              for i, (v, e) in enumerate(files)]
    g = graphs[0] if len(graphs) == 1 else merge_many(graphs, reverse=reverse)
    # reused by every output below: cut the lineage once
    return Graph(checkpoint(g.vertices), checkpoint(g.edges))


def run(spark, out: str, files: list, threshold: int, second: list | None = None,
        second_threshold: int = 8, reverse: bool = False, raw_line: bool = False,
        rejects: str | None = None) -> None:
    g = merged(spark, files, threshold, reverse, raw_line, rejects)
    write_gexf(g, os.path.join(out, "graph.gexf"))
    write_components(connected_components(g), os.path.join(out, "components.txt"))
    write_gexf(low_degree_subgraph(g), os.path.join(out, "low_degree.gexf"))
    if second:
        g2 = merged(spark, second, second_threshold, reverse, raw_line, rejects and os.path.join(rejects, "second"))
        write_gexf(g2, os.path.join(out, "second_graph.gexf"))


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    p.add_argument("--out", required=True)
    p.add_argument("--graph", nargs=2, action="append", required=True, metavar=("VERTICES", "EDGES"))
    p.add_argument("--threshold", type=int, default=15)
    p.add_argument("--second", nargs=2, action="append", metavar=("VERTICES", "EDGES"))
    p.add_argument("--second-threshold", type=int, default=8)
    p.add_argument("--reverse", action="store_true", help="flip edges as a (dst, src)-keyed merge does")
    p.add_argument("--raw-line", action="store_true", help="count identical raw lines, not parsed pairs")
    p.add_argument("--rejects", help="folder for lines that cannot be parsed (without it they fail the job)")
    p.add_argument("--master")
    a = p.parse_args(argv)
    spark = get_session(a.master, "tagloom-graph-report")
    run(spark, a.out, a.graph, a.threshold, a.second, a.second_threshold, a.reverse, a.raw_line, a.rejects)


if __name__ == "__main__":
    main()
