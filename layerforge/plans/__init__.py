"""Layer plans: bronze, silver, gold, and the runs that write them."""
