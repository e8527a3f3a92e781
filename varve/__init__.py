"""varve: Spark operators for messy observational data, and layered plans made of them."""
