"""DataFrame operators: incremental reading, change sets, cleaning, quality, joins and anomaly baselines."""
