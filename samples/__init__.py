"""The checks applied to the sample tables, with equivalent SQL for each."""
