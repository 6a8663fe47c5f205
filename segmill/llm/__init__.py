"""Operations of a training-data pipeline: deduplication, language, extraction, packing, scans."""
