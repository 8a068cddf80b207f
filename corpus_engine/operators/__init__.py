"""Table operators: order-aware upserts, ranking, positions, resume joins."""
