"""Word lists, equivalent forms, rules and report columns that results depend on. Plain data, as given."""

# Words without meaning in a catalogue query, and units written apart from their number.
STOP_WORDS = ["de", "da", "do", "das", "dos", "e", "ou", "a", "o", "as", "os", "um", "uma", "para", "com", "sem", "por", "em", "no", "na", "nos", "nas", "ao", "aos", "tipo", "material", "modelo", "cor", "medida", "tamanho"]
UNITS = ["mm", "cm", "km", "kg", "mg", "ml", "pol", "un", "g", "m", "l"]

# Forms of the same object.
VARIANT_GROUPS = [
    ["pick-up", "pickup", "pick up", "picape", "caminhonete", "camionete"],
    ["micro-ônibus", "microônibus", "micro ônibus", "micro-onibus", "microonibus"],
    ["furgão", "furgao", "van"],
    ["automóvel", "automovel", "carro", "veículo", "veiculo"],
    ["motocicleta", "moto"],
    ["utilitário", "utilitario"],
    ["revólver", "revolver"],
    ["espargidor", "spray de pimenta", "spray oc", "gás de pimenta", "gas de pimenta"],
    ["bastão retrátil", "bastao retratil", "tonfa", "cassetete"],
    ["aparelho de choque", "arma de choque", "taser", "dispositivo elétrico incapacitante"],
    ["colete balístico", "colete balistico", "colete à prova de bala", "colete a prova de bala", "colete à prova de tiro", "colete a prova de tiro", "colete antibala"],
    ["capacete balístico", "capacete balistico", "capacete à prova de bala", "capacete a prova de bala"],
    ["rádio", "radio", "rádio comunicador", "radio comunicador", "transceptor", "ht", "rádio ht", "radio ht"],
    ["celular", "smartphone", "telefone celular", "aparelho celular"],
    ["notebook", "laptop"],
    ["microcomputador", "computador", "desktop"],
    ["impressora multifuncional", "multifuncional"],
    ["disco rígido", "disco rigido", "hd", "hdd"],
    ["disco magnético", "disco magnetico"],
    ["drone", "rpas", "vant", "veículo aéreo não tripulado", "veiculo aereo nao tripulado", "veículo teleguiado", "veiculo teleguiado"],
]

# Terms that are too generic to search for, in folded form.
GENERIC_TERMS = [
    "equipamento", "aparelho", "dispositivo", "material", "sistema", "produto", "item", "unidade", "instrumento", "artefato", "maquina", "ferramenta", "acessorio", "componente", "conjunto", "kit", "mercadoria", "bem", "objeto",
    "utensilio", "peca", "modelo", "tipo", "armamento", "aeronave", "aerosol", "explosivo", "explosivos", "municoes", "vestuario", "insignia", "insignias", "pessoa", "pessoal", "profissional", "candidato", "avaliacao", "exame",
    "teste", "prova", "instalacao", "manutencao", "servico", "suporte", "coletivo", "patrimonio", "seta", "seda", "choque", "eletrochoque", "camara", "camera", "pc", "hd", "ht", "micro", "capa", "bastao", "disco", "drive", "spray",
    "nas", "servidor", "cartucho", "monitor", "esfera", "esferas", "esferoide", "passageiro", "colete", "automotriz", "carroca", "vigilancia", "monitoramento", "recrutamento", "vestibular",
    "autocarro", "biciclo", "camioneta", "furgoneta", "furgonete", "monovolume", "scuter",
]

# A part of a group's name, and the category it stands for.
GROUP_RULES = [("veiculo", "viatura"), ("municao", "municao"), ("explosivo", "municao"), ("comunicac", "equip_comunicacao"), ("radiacao", "equip_comunicacao"), ("informatica", "equip_ti"), ("fotografic", "equip_ti"), ("aeronave", "drone_rpas"), ("combate a inc", "protecao_balistica"), ("resgate", "protecao_balistica")]

# Words for confidence.
CONFIDENCE = {"alta": 1.0, "media": 0.6, "média": 0.6, "baixa": 0.3}

# Columns of the report, in order.
REPORT_COLUMNS = ["Codigo CATMAT/CATSER", "Material/Servico", "Tipo", "Nome", "Descricao Base", "Descricao Especifica", "Orgao", "CNPJ Orgao", "UF", "Num Controle PNCP", "Seq Compra", "Seq Ata", "Ano", "Item", "Unidade", "Quantidade", "Valor Homologado", "Valor Estimado", "Fornecedor", "Data Resultado", "Origem", "Fim de Vigencia"]
