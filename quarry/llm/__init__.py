"""Operations of a training-data pipeline: deduplication, mixing, search, decontamination,
language-model scoring, URL rules, personal data and toxicity.  One module per operator;
``queries`` applies each with production parameters to its whole table."""
