"""DataFrame -> DataFrame operators: validation rules and funnel (``quality``),
silver join and enrichment (``enrich``), marts (``marts``) and page reads
(``paging``)."""
