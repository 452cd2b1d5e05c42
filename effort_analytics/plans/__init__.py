"""Domain compositions: calendar, refine, targets, published facts, test-data analogues."""
