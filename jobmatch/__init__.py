"""Job-matching analytics on Spark: DataFrame in, DataFrame out.

Sub-packages:
  sources    -- readers for feeds, vocabularies, corpora, pages, resumes, models
  functions  -- column expressions and the few Arrow (pandas) functions
  operators  -- tagging, model, matching, text dataflows, skill counts, pages, sinks
  plans      -- size checks, lineage cuts, skew-safe ranking, batch jobs, the named queries
  streaming  -- Structured Streaming jobs

The main entry points are importable from the package itself (loaded on first use).
"""

_EXPORTS = {
    "get_session": ("jobmatch.session", "get_session"),
    "Vocabulary": ("jobmatch.operators.tagging", "Vocabulary"),
    "tag_skills": ("jobmatch.operators.tagging", "tag_skills"),
    "build_model": ("jobmatch.operators.model", "build_model"),
    "match_batch": ("jobmatch.operators.match", "match_batch"),
    "match_terms": ("jobmatch.operators.match", "match_terms"),
    "result_links": ("jobmatch.operators.match", "result_links"),
    "word_line_index": ("jobmatch.operators.textflows", "word_line_index"),
    "word_count": ("jobmatch.operators.textflows", "word_count"),
    "token_count_filtered": ("jobmatch.operators.textflows", "token_count_filtered"),
    "skill_counts": ("jobmatch.operators.skills", "skill_counts"),
    "ingest_pages": ("jobmatch.operators.pages", "ingest_pages"),
    "extract_sections": ("jobmatch.operators.pages", "extract_sections"),
}

__all__ = sorted(_EXPORTS)


def __getattr__(name):
    if name in _EXPORTS:
        import importlib
        module, attr = _EXPORTS[name]
        return getattr(importlib.import_module(module), attr)
    raise AttributeError(name)
