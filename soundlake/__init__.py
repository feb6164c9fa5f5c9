"""soundlake: DataFrame operators for multi-sensor underwater track surveys."""
