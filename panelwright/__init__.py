"""Panel building, record linkage, auditing and large-scale data preparation on PySpark.

Everything is expressed as DataFrame plans.  Python runs only where Spark has no
operator for the job (file formats, tokenizer merges, mail bodies).
"""

__version__ = "0.1.0"
