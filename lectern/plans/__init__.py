"""Jobs made of sources and operators."""
