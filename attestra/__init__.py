"""Evidence-review analytics as Spark jobs: gates, joins, scores, rankings, ledgers and reports."""
