"""The layers of the warehouse, one function per table or report."""
