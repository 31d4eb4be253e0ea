"""DataFrame-to-DataFrame steps: keep-first, scoring, histograms, joins, sampling, voting."""
