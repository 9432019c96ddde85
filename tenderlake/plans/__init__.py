"""The jobs: ingest, load, aggregate, train, score, and the backtest."""
