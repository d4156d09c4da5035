from edgewise.sources.files import (  # noqa: F401
    read_features, read_pairs, read_scores, write_baseline, write_edges, write_features,
    write_metrics, write_pairs, write_scores,
)
from edgewise.sources.graphs import (  # noqa: F401
    customer_vertices, events_edges_raw, events_graph, graph, orders_edges_raw,
    orders_graph, read_edge_list, simple_graph, table,
)
