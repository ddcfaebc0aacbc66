"""Jobs made of steps, and the queries that check them."""
