"""Writers: reports, chart JSON, GEXF, component lines, token chunks."""
