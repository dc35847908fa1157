"""Catalogue analytics on PySpark: tags, pairwise comparison, rankings, documents and feeds."""

from .functions.dates import parse_document_date, parse_site_date
from .functions.infobox import (
    infobox_first,
    infobox_subtype,
    infobox_type,
    normalize_infobox,
    parse_infobox,
)
from .functions.text import map_chars, normalize_tag, strip_controls, strip_nul
from .functions.urls import next_page_url, pages_remaining
from .operators.api import api_collections, api_documents, api_subjects, api_users
from .operators.documents import build_documents, build_suggestions
from .operators.extract import (
    extract_pages,
    html_pages,
    page_friends,
    page_home_users,
    page_indexes,
    page_links,
    page_records,
    page_subjects,
    page_users,
)
from .operators.pairs import co_rating_pairs, compare_pairs, user_cdf
from .operators.ranking import (
    borda_merge,
    custom_rank,
    rank_keener,
    rank_lists,
    rank_markov,
    rank_massey,
    rank_od,
)
from .operators.snapshots import snapshot_diff
from .operators.subjects import (
    display_name,
    eligible_subjects,
    enrich_subjects,
    first_non_null,
    flatten_stats,
    resolve_type,
    subject_aliases,
)
from .operators.tags import tag_confidence, tag_table, user_authority
from .plans.nightly import Paths, run_pipeline
from .sources.ledger import Ledger
from .sources.readers import (
    latest_by,
    latest_snapshot,
    read_csv,
    read_jsonlines,
    read_lines_with_key,
    read_tsv,
)
from .sources.writers import (
    route,
    write_chunked,
    write_csv,
    write_item_tsv,
    write_jsonlines,
    write_numbered,
    write_routed,
    write_tsv,
)

__all__ = [name for name in dir() if not name.startswith("_")]
