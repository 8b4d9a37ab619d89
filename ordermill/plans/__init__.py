"""Dashboard queries and the ordered list of layer builders."""
