"""Jobs built from the operators: snapshots, models, cards, run log."""
