"""Operations of a training-data pipeline: extraction, audits, scoring, filters, deduplication, tokens."""
