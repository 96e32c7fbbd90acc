"""The pipeline: staging -> star -> views -> worksheets and questions."""
