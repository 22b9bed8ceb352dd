"""Jobs: staging, imputation, the whole run, additional outputs, legacy conversion."""
