"""Joint training: many model configurations and folds over one packed frame, one Spark job a step for all of them."""
