"""Ranked keyword search over web-crawl archives, as Spark jobs."""

from .functions.fixed_values import STOP_WORDS
from .functions.urls import (
    domain_pattern,
    is_http,
    top_level_domain,
    unify_scheme,
    url_host,
)
from .operators.impact import search_impact
from .operators.keywords import page_keywords, term_counts, tokens
from .operators.links import (
    absolute_links,
    domain_index,
    domain_link_lists,
    edge_multiplicity,
    edges_of,
    host_counts,
    link_edges,
    link_hosts,
    link_vertices,
    links_long,
    out_degree,
    page_links,
    vertices_of,
)
from .operators.postings import (
    index_stats,
    inverted_index,
    postings,
    postings_by_position,
    ranked_pages,
)
from .operators.rank import page_rank, page_rank_by_residuals, rank_names, top_domains
from .operators.search import (
    hit_counts,
    keyword_lookup,
    scores,
    search,
    search_multi,
    search_multi_batch,
    search_with_totals,
)
from .plans.jobs import (
    build_index,
    domain_ranks,
    numbered_postings,
    ranked_postings,
    unranked_postings,
)
from .sources.graph_store import crawls, page_host_counts, read_link_graph, update_link_graph
from .sources.impact_store import ImpactIndex, read_impact_index, write_impact_index
from .sources.index_store import create_index_table, read_index, write_index
from .sources.packed_store import read_packed_index, unpacked, write_packed_index
from .sources.rank_store import (
    rank_versions,
    read_domains,
    read_ranks,
    with_ranks,
    write_ranks,
)
from .sources.segment_store import (
    append_segment,
    compact_segments,
    read_pages,
    read_segments,
    segments,
)
from .sources.sketch_store import ERROR as SKETCH_ERROR
from .sources.sketch_store import add_sketches, estimated_stats, merged_sketches
from .sources.warc import (
    header_field,
    header_fields,
    pages_by_top_domain,
    read_records,
    split_record,
    wat_pages,
    wet_pages,
    write_records,
)
